"""Operators of a training-data pipeline; nothing else in the library imports this package.

Registered queries and their DuckDB oracles are in ``queries``.
"""
