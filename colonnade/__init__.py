"""Colonnade: data-science operations expressed on Spark DataFrames."""
