"""Operators: DataFrame in, DataFrame out, driven by a ``TableSpec``."""
