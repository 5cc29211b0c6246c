"""Operators for training data: each module takes and returns DataFrames."""
