"""Whole jobs, and the query catalogue over the test tables."""
