"""Operators for preparing training text at scale.

Every operator is a function from DataFrames to a DataFrame.  Nothing else in the
library imports this subpackage.
"""
