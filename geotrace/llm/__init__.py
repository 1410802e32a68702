"""Operators of a training-data pipeline (packing, sharding, near-dedup, scoring, mixing, WARC, URL rules).

Nothing else in the library imports this subpackage.
"""
