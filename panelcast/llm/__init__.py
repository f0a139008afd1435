"""Training-data operators: search, near-duplicates, packing, fingerprints, tokens, models.

Nothing outside this subpackage imports it.
"""
