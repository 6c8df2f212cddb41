"""Operators put together: the daily jobs, and the queries over the test tables."""
