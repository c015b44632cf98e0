"""Operators for large text corpora: one module each, with queries in ``queries.py``."""
