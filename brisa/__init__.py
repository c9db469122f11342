"""Analytics over environmental sensor networks, written for Spark DataFrames."""
