"""Operators for large-scale training-data pipelines over document tables.

Nothing else in the library imports this subpackage; it can be removed whole.
"""
