"""Scalar column expressions (text, numeric, vector, weights)."""
