"""Named queries over the driver's tables, each with its SQL oracle."""

from plyforge.plans import chess, metrics, modeling, scalars, warehouse  # noqa: F401
from plyforge.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
