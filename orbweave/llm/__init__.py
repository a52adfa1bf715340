"""Operators of a training-data pipeline: extraction, filtering, deduplication, scoring, packing.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` registers the thin queries.
"""
