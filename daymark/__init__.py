"""daymark: dated-snapshot customer data marts as plain functions over Spark DataFrames."""
