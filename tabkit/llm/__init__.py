"""Operators for preparing training text: one module per operator.

Nothing else in the library imports this subpackage. Each operator takes
and returns DataFrames; ``queries.py`` binds them to the driver tables.
"""
