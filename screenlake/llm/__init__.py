"""Training-data operators: search, fingerprints, scoring, counting, archives, joins and packing.

Nothing outside this folder imports it, so it can be removed as a whole.
"""
