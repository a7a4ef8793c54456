"""Medallion (bronze / silver / gold) analytics on Spark DataFrames."""
