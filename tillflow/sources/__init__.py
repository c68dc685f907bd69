"""Schemas, tables, generated rows and views over the given tables."""
