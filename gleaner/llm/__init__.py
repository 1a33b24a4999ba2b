"""Operators that prepare training data: sharding, packing, near duplicates, quality, archives.

Nothing else in the library imports this package. Each module holds one operator
by one method; ``queries`` registers the digests the checks compare.
"""
