"""Operators of a training-data pipeline: one module per operator, with its query.

Nothing else in the library imports this subpackage.
"""
