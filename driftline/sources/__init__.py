"""Readers: stored tables, and the tables derived from the supplied test data."""
