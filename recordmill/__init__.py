"""Curation of collected records on Spark: clean, parse, merge, number, audit."""
