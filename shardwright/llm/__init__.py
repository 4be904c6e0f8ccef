"""Training-data operators: filters, near-duplicate removal, search, mixing, packing.

Nothing else in the library imports this subpackage.
"""
