"""Operators of a training-data pipeline over document and vector tables.

Each module holds one operator (general interface) built on the shared
helpers in ``common`` (lineage cuts, split ranking), ``flat`` (vectorised
text) and ``linkage`` (pair search and components).  ``queries`` registers
them under their ``opN_`` names.  Nothing outside this package imports it.
"""
