"""Matching operators over DataFrames."""
