"""Incremental lake loading and dimensional modelling of all-text source files, on Spark DataFrames."""
