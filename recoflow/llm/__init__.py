"""Training-data operators: sharding, archives, decontamination, quality, near-duplicates, packing.

Each module holds one operator and its thin ``opN_`` query; ``catalog`` lists them.
Nothing outside this sub-package imports it.
"""
