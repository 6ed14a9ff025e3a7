"""Versions of keyed rows: latest per key, snapshot, merge and change feeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DELETE, UPDATE = "D", "U"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the greatest ``order`` for every key.

    ``row_number() = 1`` is planned with a window group limit on both sides of
    the shuffle, so each task sends at most one row per key and a hot key costs
    no more than any other.
    """
    newest_first = W.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def with_keys_of(
    table: DataFrame, other: DataFrame, keys: Sequence[str], how: str,
    extra: Sequence[str] = (), condition: Column | None = None,
) -> DataFrame:
    """Join on the keys, where NULL equals NULL as it does within a window."""
    marked = other.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *extra)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    on = same if condition is None else same & condition
    return table.join(marked, on, how).drop(*[f"_key_{k}" for k in keys])


def _latest_of_both(
    older: DataFrame, newer: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Latest per key of two tables; on a tie the newer table wins."""
    both = older.withColumn("_newer", F.lit(0)).unionByName(
        newer.select(*older.columns).withColumn("_newer", F.lit(1))
    )
    return latest_per_key(both, keys, [*order, F.col("_newer")]).drop("_newer")


def read_snapshot(
    base: DataFrame,
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    unique_base: bool = False,
) -> DataFrame:
    """Real-time view of a table: base files merged with the later versions.

    ``unique_base`` states that the base holds one row per key, as every
    upserted table does. Then the log is reduced on its own and merged, and a
    large base with a small log is not shuffled at all. A base filled by plain
    appends may repeat keys and goes through the comparison with the log.
    """
    if unique_base:
        return merge_latest(base, latest_per_key(log, keys, order), keys, order)
    return _latest_of_both(base, log, keys, order)


def merge_latest(
    table: DataFrame,
    newest: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    incoming_wins: bool = False,
) -> DataFrame:
    """Upsert ``newest`` (one row per key) into ``table`` (one row per key).

    The table is read once in full, through an anti-join that drops the rows an
    update replaces, and once more with only its key and order columns, to find
    the updates that come too late. While the updates fit in a broadcast no
    table row is shuffled. An update wins a tie; ``incoming_wins`` lets it win
    always and saves the second read.
    """
    newest = newest.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema])
    if incoming_wins:
        return with_keys_of(table, newest, keys, "left_anti").unionByName(newest)
    version = F.struct(*order)
    versioned = table.withColumn("_old", version)
    updates = newest.withColumn("_new", version)
    too_late = F.col("_old") > F.col("_new")
    untouched = with_keys_of(versioned, updates, keys, "left_anti", ["_new"], ~too_late)
    late = with_keys_of(
        versioned.select(*keys, "_old"), updates, keys, "left_semi", ["_new"], too_late
    )
    winners = with_keys_of(newest, late, keys, "left_anti")
    return untouched.drop("_old").unionByName(winners)


def apply_changes(
    table: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    op: str = "op",
) -> DataFrame:
    """Apply an insert / update / delete feed; the last change of a key wins.

    Table columns that the feed does not carry keep their old value where the
    feed only updates the row, and are NULL for a row that it inserts, also
    after it has deleted one with the same key.
    """
    missing = [c for c in table.columns if c not in changes.columns]
    last = latest_per_key(changes, keys, order)
    untouched = with_keys_of(table, last, keys, "left_anti")
    written = last.where(F.col(op) != DELETE)
    if missing:
        replaced = changes.where(~F.col(op).eqNullSafe(UPDATE)).select(*keys).distinct()
        old = with_keys_of(table.select(*keys, *missing), replaced, keys, "left_anti")
        written = with_keys_of(written, old, keys, "left", missing)
    return untouched.unionByName(written.select(*table.columns))


def current_scans(scans: DataFrame, arrival: Sequence[str] = ()) -> DataFrame:
    """The latest version of every scan of a table that stores all of them.

    Arrival decides where its columns are given; a void repeats the time of its
    sale with quantity 0, so without them the lower quantity is the later one.
    """
    return latest_per_key(scans, ["scan_id"], [*[F.col(c) for c in arrival], -F.col("unit_qty")])


def publish_views(
    name: str, base: DataFrame, log: DataFrame, keys: Sequence[str], order: Sequence[Column],
    unique_base: bool = False,
) -> None:
    """Views for SQL users: ``<name>_ro`` shows base files, ``<name>_rt`` the snapshot."""
    base.createOrReplaceTempView(f"{name}_ro")
    read_snapshot(base, log, keys, order, unique_base).createOrReplaceTempView(f"{name}_rt")
