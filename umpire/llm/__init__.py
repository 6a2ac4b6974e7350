"""Training-data operators: deduplication, filtering, packing and mixing.

Nothing else in the library imports this subpackage.
"""
