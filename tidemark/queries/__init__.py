"""Registered queries over the driver's tables, each with an equivalent SQL text where one exists."""

from tidemark.queries import (  # noqa: F401  (importing registers the queries)
    changes,
    events,
    integrity,
    monitoring,
    quality,
    star,
    streaming,
    trips,
    versions,
)
from tidemark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
