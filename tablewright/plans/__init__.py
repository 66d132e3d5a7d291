"""Queries over the tables, with their DuckDB twins."""
