"""Analytics for entity x season x period panels on Spark DataFrames."""
