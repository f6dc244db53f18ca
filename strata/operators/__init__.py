"""Operators: DataFrame in, DataFrame out. Column names are arguments, so the cleaning
and serving operators work on any categorical table."""
