"""Retail analytics on Spark: landing reads to a reconciled revenue star."""
