"""Training-data operators: archives, sharding, packing, filtering and deduplication.

Nothing else in the library imports this subpackage.
"""
