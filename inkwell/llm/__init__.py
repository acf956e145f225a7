"""Training-data operators: extraction, classifiers, deduplication, packing and search.

Nothing else in the library imports this subpackage; ``registry`` lists its queries.
"""
