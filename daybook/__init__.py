"""Accounting and inventory analytics on Spark DataFrames."""
