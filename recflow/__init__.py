"""recflow: recommendation analytics on Spark DataFrames."""
