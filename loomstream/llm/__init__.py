"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; the ``opN_<name>`` queries in ``queries.py`` are thin
adapters over them.
"""
