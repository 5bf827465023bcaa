"""Detection and tracking analytics on Spark DataFrames."""
