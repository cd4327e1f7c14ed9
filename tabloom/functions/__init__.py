"""Scalar functions: each takes and returns columns."""
