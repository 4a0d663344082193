"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` and
``queries.SQL`` hold the registered queries and their DuckDB SQL.
"""
