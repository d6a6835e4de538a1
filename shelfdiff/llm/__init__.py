"""Operators for preparing training text, each on plain Spark tables.

Nothing else in the package imports this subpackage. `queries` has one query per
operator over the given tables.
"""
