"""statuta: versioned-text analytics on Spark DataFrames."""
