"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general interface; ``queries`` registers
the thin ``opN_*`` queries over the given tables and their SQL.  Nothing
outside this package imports it.
"""
