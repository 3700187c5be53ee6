"""Operators of a training-data pipeline: one module for each, queries over the test tables.

Every operator takes DataFrames and returns one; the work runs in Spark tasks, with numpy on
Arrow batches where built-in functions cannot express it.
"""
