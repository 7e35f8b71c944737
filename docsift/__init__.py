"""Document search and index maintenance on Spark DataFrames."""
