"""Training-data operators: near-duplicates, scans, mixing, scoring and formatting.

Nothing outside this package imports it.
"""
