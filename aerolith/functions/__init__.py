"""Scalar expressions on columns."""
