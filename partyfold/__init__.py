"""Flat party tables for insurance policies, built as plain Spark DataFrame jobs."""
