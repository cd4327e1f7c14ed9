"""Every registered query with its SQL."""

from tabloom.queries import aggregates, evaluate, features, joins, models, recommend, rows, sources, wide, windows  # noqa: F401
from tabloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
