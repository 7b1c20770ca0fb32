"""A point-in-time analytics engine on Spark DataFrames."""
