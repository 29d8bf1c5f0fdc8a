"""The operators bound to the test tables, each with its SQL counterpart where one exists."""

from . import (  # noqa: F401
    aggregates,
    columns,
    filters,
    flows,
    joins,
    modelling,
    ordering,
    scalars,
    sources,
    statistics,
    streams,
)
from .registry import QUERIES, oracles

__all__ = ["QUERIES", "oracles"]
