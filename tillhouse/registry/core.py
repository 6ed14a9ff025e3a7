"""Registry of queries that run on the test tables, with their SQL check.

A query states its output columns once, as ``name type`` with the types
``bigint``, ``double``, ``text`` and ``boolean``; both the DataFrame and the
SQL result are cast to them. Dates and times are compared as ISO text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.session import configure

Run = Callable[[SparkSession, str], DataFrame]

_SPARK_TYPES = {"bigint": "bigint", "double": "double", "text": "string", "boolean": "boolean"}
_SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "text": "VARCHAR", "boolean": "BOOLEAN"}


class Query(NamedTuple):
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(columns: str, sql: str | None = None, views: Sequence[str] = (), name: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` with its SQL check.

    ``views`` names shared views of ``registry.views`` the SQL builds on.
    """
    spec = [part.split() for part in columns.split(",")]

    def add(run: Run) -> Run:
        def shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
            result = run(configure(spark), sf_dir)
            return result.select(*[F.col(c).cast(_SPARK_TYPES[t]).alias(c) for c, t in spec])

        REGISTRY[name or run.__name__] = Query(shaped, None if sql is None else _check(sql, views, spec))
        return run

    return add


def _check(sql: str, views: Sequence[str], spec: list[list[str]]) -> str:
    from tillhouse.registry.views import with_views

    casts = ", ".join(f"CAST({c} AS {_SQL_TYPES[t]}) AS {c}" for c, t in spec)
    return f"{with_views(views)}SELECT {casts} FROM ({sql.strip()}) AS result"
