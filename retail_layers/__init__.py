"""Layered retail analytics on Spark: clean, enrich, star schema, marts."""
