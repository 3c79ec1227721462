"""Queries over the benchmark tables, and the SQL that must give the same."""
