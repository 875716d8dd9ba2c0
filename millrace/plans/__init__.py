"""Whole jobs, and the queries over the sample tables."""
