"""Scan records as JSON text and the contract they must keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.temporal import format_time
from tillhouse.schemas import RETAIL_SCANS

_BROKEN = "_broken_record"


def scan_json(scans: DataFrame) -> Column:
    """One scan as a JSON object with the six declared fields."""
    if "scan_datetime" in scans.columns:
        when = F.col("scan_datetime")
    else:
        when = format_time(F.col("scan_ts"))
    return F.to_json(F.struct(
        F.col("scan_id").cast("string").alias("scan_id"),
        F.col("store_id"),
        when.alias("scan_datetime"),
        F.col("item_upc"),
        F.col("unit_qty"),
        F.col("unit_price"),
    ))


def parsed_once(parsed: Column) -> Column:
    """Keep an expensive parse from being repeated.

    Filters on parsed fields are pushed down and would parse the text again
    for each field they use; they do not pass a one-element explode.
    """
    return F.explode(F.array(parsed))


def check_contract(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse JSON lines against the declared scan schema.

    Adds the parsed fields and ``problem``: NULL for a good record, otherwise
    ``malformed``, ``missing <fields>`` or ``negative quantity``.
    """
    schema = T.StructType(RETAIL_SCANS.fields + [T.StructField(_BROKEN, T.StringType())])
    parsed = F.from_json(
        F.col(column), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    )
    rows = lines.withColumn("_record", parsed_once(parsed))
    absent = F.concat_ws(",", *[
        F.when(F.col(f"_record.{f.name}").isNull(), F.lit(f.name)) for f in RETAIL_SCANS.fields
    ])
    problem = (
        F.when(F.col("_record").isNull() | F.col(f"_record.{_BROKEN}").isNotNull(), F.lit("malformed"))
        .when(absent != "", F.concat(F.lit("missing "), absent))
        .when(F.col("_record.unit_qty") < 0, F.lit("negative quantity"))
    )
    fields = [F.col(f"_record.{f.name}").alias(f.name) for f in RETAIL_SCANS.fields]
    kept = [c for c in lines.columns if c not in RETAIL_SCANS.names]
    return rows.select(*kept, *fields, problem.alias("problem"))


def split_by_contract(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good scans and rejected lines."""
    checked = check_contract(lines, column)
    good = checked.where(F.col("problem").isNull()).select(*RETAIL_SCANS.names)
    rejected = checked.where(F.col("problem").isNotNull()).select(column, "problem")
    return good, rejected
