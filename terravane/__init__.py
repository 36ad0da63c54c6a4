"""Site-selection analytics on Spark DataFrames."""
