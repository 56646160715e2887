"""Operators for preparing training data; nothing else in the library imports them.

Each module holds one operator, `queries` registers them with their SQL.
"""
