"""DataFrame operators: records, pairs, moments, graph, sinks."""
from . import graph, joins, moments, pairs, records, sinks  # noqa: F401
