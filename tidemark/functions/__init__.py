"""Column-to-column builders; every one is a built-in Spark expression."""
