"""Operators for large training corpora: filters, deduplication, search, sharding and tokens.

Nothing else in the library imports this subpackage.
"""
