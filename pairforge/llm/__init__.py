"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
contract queries and their SQL twins.
"""
