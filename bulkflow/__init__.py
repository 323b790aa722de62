"""Load, publish, retain and verify bulk data with Spark DataFrames."""
