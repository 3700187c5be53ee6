"""Queries over the test tables, one per operator, and their SQL counterparts."""
