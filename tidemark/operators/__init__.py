"""Table operators: statistics, joins, splits and decisions."""
