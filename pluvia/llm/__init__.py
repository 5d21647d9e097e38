"""Training-data operators: token counts, scoring, mixing, archives, sharding, cleaning and near-duplicates.

Nothing outside this subpackage imports it.
"""
