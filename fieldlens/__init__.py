"""Batch analytics over JSON client submissions, written as Spark DataFrame operations."""
