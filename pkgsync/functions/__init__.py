"""Column expressions (no I/O): paths, coordinates, predicates."""

from . import filters, paths  # noqa: F401
