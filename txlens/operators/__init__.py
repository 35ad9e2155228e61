"""Operators: every public function maps DataFrames to a lazy DataFrame."""
