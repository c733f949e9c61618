"""Operators for preparing training data, the queries over the test tables, and their SQL."""
