"""Operators for building large text training sets."""
