"""Operators over DataFrames, by theme."""
