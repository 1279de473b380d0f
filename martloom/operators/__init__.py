"""Relational building blocks shared by the marts."""
