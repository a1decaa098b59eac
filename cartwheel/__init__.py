"""Commerce behaviour analytics on Spark DataFrames and Structured Streaming."""
