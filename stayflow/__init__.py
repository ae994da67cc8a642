"""Analytics on multi-site clinical time series, on Spark DataFrames."""
