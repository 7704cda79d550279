"""Operators for training-data pipelines over raw document tables.

Nothing outside this package imports it. ``queries.py`` holds the registered
queries; every other module is one operator.
"""
