"""Payment-graph fraud analytics on Spark DataFrames."""
