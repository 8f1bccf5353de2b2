"""Operators for training-data pipelines.

Each module holds one operator with a general interface (any id and text
column) and, beside it, the thin ``opN_<name>`` query that applies it to the
driver's tables with production parameters. ``queries.py`` lists them.
Nothing else in the library imports this subpackage.
"""
