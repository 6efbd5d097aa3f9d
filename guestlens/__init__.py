"""Review analytics and recommendation on Spark DataFrames."""
