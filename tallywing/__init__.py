"""Batch analytics over titles, link graphs and flight records, as Spark DataFrame jobs."""
