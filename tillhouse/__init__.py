"""Retail point-of-sale analytics on PySpark DataFrames, Spark SQL, MLlib and Structured Streaming."""
