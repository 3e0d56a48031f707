"""Order-fulfilment analytics on Spark DataFrames."""
