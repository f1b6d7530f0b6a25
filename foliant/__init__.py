"""Foliant: versioned document corpora as Spark DataFrames."""
