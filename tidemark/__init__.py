"""Monthly credit-risk snapshots, features and drift monitoring on Spark DataFrames."""

__version__ = "0.1.0"
