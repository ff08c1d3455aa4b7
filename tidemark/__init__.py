"""Tidemark: event and incident analytics expressed as Spark DataFrames."""
