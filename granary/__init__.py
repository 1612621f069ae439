"""Spark operators for a commodity-price lakehouse.

Every operator is a function from DataFrames to a DataFrame; readers and
writers are thin, and the session, paths and load time are always arguments.
"""
