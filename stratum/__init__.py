"""Stratum: layered (bronze, silver, gold) analytics on Spark DataFrames."""
