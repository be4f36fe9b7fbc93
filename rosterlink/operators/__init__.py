"""Whole-job operators over DataFrames."""
