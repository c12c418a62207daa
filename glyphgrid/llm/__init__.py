"""Corpus operators for training-data pipelines.

Nothing outside this package imports it; ``queries.py`` holds the thin
contract queries that ``__spark_entry__.py`` registers when it is present.
"""
