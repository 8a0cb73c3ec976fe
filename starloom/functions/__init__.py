"""Scalar expressions. Everything here is a native Column expression, never a Python UDF."""
