"""DataFrame operators: each takes and returns Spark DataFrames."""
