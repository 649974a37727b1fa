"""Operators of a training-data pipeline: quality, sharding, encoding, scoring, mixing, counts, deduplication, joins, search.

Nothing else in the package imports this folder. ``queries`` has the registered queries and their SQL.
"""
