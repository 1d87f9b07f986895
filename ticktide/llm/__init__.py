"""Operators for preparing training text at scale.

Each module holds one operator; `queries` registers them over the given tables.
Nothing else in the library imports this package.
"""
