"""Retail warehouse, OLAP, mining and review analytics on Spark DataFrames.

Every operator takes DataFrames and parameters and returns a DataFrame; nothing is collected except model
coefficients and fitted labels, which are bounded by the number of features and classes.
"""
