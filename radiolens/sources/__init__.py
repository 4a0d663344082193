"""Scans: text records with the file-time window, point tables, JSON posts,
and the renderer that turns the given tables into call records."""
from . import records, render, tables  # noqa: F401
