"""Column-expression builders: record layout constants and in-row decoding."""
from . import decode, layout  # noqa: F401
