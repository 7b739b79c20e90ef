"""Snapshot analytics on Spark: JSON snapshot histories in, queryable collections out.

Every operator takes and returns DataFrames and is made of built-in Spark expressions.
"""
