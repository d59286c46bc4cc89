"""Attached relational catalogs on Spark: scan, push down, query, write back."""
