"""Operators of a training-data pipeline: deduplication, filters, archives, packing.

Every operator is a function from DataFrames to a DataFrame.  Nothing else in
the library imports this subpackage.
"""
