"""Item substitution and attribute importance on Spark DataFrames."""
