"""Operators: DataFrame in, DataFrame out, for tables and, where the docstring says so, streams."""
