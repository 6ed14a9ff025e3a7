"""State of the time zones kept by a stream processor, with a timer that tells when a zone falls silent.

A zone's messages are dealt to ``PARTS`` keys, so a zone with a third of all messages keeps several tasks busy. Each key
has one small state: marks that are minima, maxima and sums, so neither the order of messages nor their batches matter.
Readers put the keys of a zone together. A timer is set ``limit`` after the latest message of a key, in event time; when
it fires without a newer one, the key is silent.

Needs pandas and Arrow in the workers and the RocksDB state store (``with_state_store``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tillhouse.functions.temporal import parse_any_time
from tillhouse.operators.activity import read_messages, shape_zone_state
from tillhouse.operators.versions import latest_per_key
from tillhouse.streaming.logs import BATCH, write_log

PARTS = 4
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

MARKS = (
    T.StructType().add("known", "long").add("started", "long").add("stopped", "long")
    .add("heard", "long").add("local_time", "string")
    .add("counted", "long").add("last_batch_time", "string").add("last_batch_count", "long")
    .add("cumulative_count", "long").add("data_volume", "long").add("last_seen", "long")
)
STATE = T.StructType([T.StructField("timezone", T.StringType()), T.StructField("part", T.IntegerType()), *MARKS.fields]).add("silent", "boolean")


def with_state_store(spark: SparkSession) -> SparkSession:
    """The session with the state store that processors need; queries started before keep theirs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return spark


class ZoneMarks(StatefulProcessor):
    """Marks of one key, changed by each micro-batch of its messages."""

    def __init__(self, limit: dt.timedelta):
        self.limit_ms = int(limit.total_seconds() * 1000)

    def init(self, handle) -> None:
        self.handle = handle
        self.marks = handle.getValueState("marks", MARKS)

    def handleInputRows(self, key, rows, timerValues):
        names = MARKS.names
        state = dict(zip(names, self.marks.get())) if self.marks.exists() else dict.fromkeys(names) | {"cumulative_count": 0, "data_volume": 0}
        before = state["last_seen"]
        for frame in rows:
            self._add(state, frame)
        self.marks.update(tuple(state[n] for n in names))
        if state["last_seen"] != before:
            if before is not None:
                self.handle.deleteTimer(before + self.limit_ms)
            self.handle.registerTimer(state["last_seen"] + self.limit_ms)
        yield self._row(key, state, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self._row(key, dict(zip(MARKS.names, self.marks.get())), True)

    def close(self) -> None:
        pass

    @staticmethod
    def _add(state: dict, frame) -> None:
        def extreme(name: str, values, least: bool = False) -> None:
            if len(values):
                found = int(values.min() if least else values.max())
                state[name] = found if state[name] is None else (min if least else max)(state[name], found)

        kind, order = frame["type"], frame["seq"]
        extreme("known", order[kind.isin(["start", "scans"])], least=True)
        extreme("started", order[kind == "start"])
        extreme("stopped", order[kind == "stop"])
        extreme("last_seen", frame["seen_ms"])
        for mark, rows, fields in (
            ("heard", frame, {"local_time": "localTime"}),
            ("counted", frame[kind == "scans"], {"last_batch_time": "timestamp", "last_batch_count": "batchCount"}),
        ):
            if len(rows):
                last = rows.loc[rows["seq"].idxmax()]
                if state[mark] is None or last["seq"] > state[mark]:
                    state[mark] = int(last["seq"])
                    for name, source in fields.items():
                        value = last[source]
                        state[name] = None if value is None or value != value else value if isinstance(value, str) else int(value)
        scans = frame[kind == "scans"]
        state["cumulative_count"] += int(scans["batchCount"].sum())
        state["data_volume"] += int(scans["dataVolume"].sum())

    @staticmethod
    def _row(key, state: dict, silent: bool):
        import pandas as pd

        return pd.DataFrame([[*key, *(state[n] for n in MARKS.names), silent]], columns=STATE.names).astype(
            {f.name: "Int64" for f in MARKS.fields if isinstance(f.dataType, T.LongType)})


def zone_marks(lines: DataFrame, order: Column, delay: str, limit: dt.timedelta) -> DataFrame:
    """A stream of the changed keys' marks. Messages older than the watermark, ``delay`` behind the latest, are dropped."""
    messages = read_messages(lines).where(F.col("problem").isNull())
    seen = parse_any_time(F.col("timestamp")).cast("timestamp")
    keyed = messages.select(
        order.cast("bigint").alias("seq"), seen.alias("seen"), F.unix_millis(seen).alias("seen_ms"), "type", "timezone", "timestamp",
        "localTime", "batchCount", "dataVolume", F.pmod(F.xxhash64(order), F.lit(PARTS)).cast("int").alias("part"))
    return keyed.withWatermark("seen", delay).groupBy("timezone", "part").transformWithStateInPandas(
        statefulProcessor=ZoneMarks(limit), outputStructType=STATE, outputMode="Update", timeMode="EventTime")


def log_zone_marks(
    lines: DataFrame, order: Column, path: str, checkpoint: str, delay: str, limit: dt.timedelta, available_now: bool = True
) -> StreamingQuery:
    """Log the marks of every key that a micro-batch or a timer changed."""
    with_state_store(lines.sparkSession)
    return write_log(zone_marks(lines, order, delay, limit), path, checkpoint, "update", available_now=available_now)


def current_zones(log: DataFrame) -> DataFrame:
    """The state of every zone as ``activity.zone_state`` has it, and whether it is silent."""
    # In one micro-batch a timer speaks after the messages.
    newest = latest_per_key(log, ["timezone", "part"], [F.col(BATCH), F.col("silent")])
    marks = newest.groupBy("timezone").agg(
        F.min("known").alias("_known"), F.max("started").alias("_started"), F.max("stopped").alias("_stopped"),
        F.max_by("local_time", "heard").alias("local_time"), F.max_by("last_batch_time", "counted").alias("last_batch_time"),
        F.max_by("last_batch_count", "counted").alias("last_batch_count"), F.sum("cumulative_count").alias("cumulative_count"),
        F.sum("data_volume").alias("data_volume"), F.min("silent").alias("is_silent"))
    return shape_zone_state(marks.where(F.col("_known").isNotNull())).join(marks.select("timezone", "is_silent"), "timezone")
