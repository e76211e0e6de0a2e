"""Operators for preparing training data: one module per operator, plus their queries and SQL.

Nothing else in the library imports this subpackage.
"""
