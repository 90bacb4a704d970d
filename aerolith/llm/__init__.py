"""Operators for preparing training text: formatting, packing, deduplication,
scoring, extraction, tokenising and search.  Nothing else in the library
imports this subpackage."""
