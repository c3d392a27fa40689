"""Analytics over positioned document text, on Spark DataFrames."""
