"""Pairwise time-series measures and the graphs derived from them, on Spark DataFrames."""
