"""Operators of a training-data pipeline (toxicity, near-duplicates, token
ids, substring dedup, WARC, PII, decontamination, sharding, secrets).

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries and their SQL.
"""
