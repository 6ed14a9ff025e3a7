"""Queries on the test tables, each with its SQL check where SQL can express it."""

from tillhouse.registry import activity, arrivals, changes, invariants, learning, sales, streams, strings, tables  # noqa: F401
from tillhouse.registry.core import REGISTRY  # noqa: F401
