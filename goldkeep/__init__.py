"""Master-data management and governance analytics on Spark DataFrames."""
