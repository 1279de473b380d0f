"""Roles of the test tables: which of their columns stand for which input of the marts.

Each module registers queries with the SQL that gives the same rows.
"""

from martloom.bindings.registry import oracles, queries

__all__ = ["oracles", "queries"]
