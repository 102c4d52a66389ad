"""Operators over manifests. Each takes and returns DataFrames."""
