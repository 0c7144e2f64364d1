"""Operators of a training-data pipeline: mixing, secret scans, vector
search, HTML extraction, quality rules, near-duplicates, token files,
packing, chat formatting and line dedup. Nothing else in the library
imports this subpackage."""
