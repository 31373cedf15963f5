"""Relational operators of the model graph. Each takes and returns DataFrames."""
