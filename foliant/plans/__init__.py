"""Composite plans and the queries over the test tables."""
