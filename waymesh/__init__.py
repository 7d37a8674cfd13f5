"""waymesh: trail-network analytics on Spark DataFrames."""
