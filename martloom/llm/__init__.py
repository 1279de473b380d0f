"""Operators for preparing training text: deduplication, filtering, scoring, extraction and packing.

Nothing outside this subpackage imports it.
"""
