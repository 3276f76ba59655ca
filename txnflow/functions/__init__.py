"""Scalar functions, all built from native Spark expressions."""
