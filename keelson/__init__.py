"""Spark jobs for the data work around tabular machine learning."""

from keelson.spec import TableSpec, expected, house_spec

__all__ = ["TableSpec", "expected", "house_spec"]
