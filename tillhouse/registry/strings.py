"""String operations and scalar functions on whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillhouse.functions import money, temporal
from tillhouse.functions.text import apply_string_op, string_op
from tillhouse.registry.core import query
from tillhouse.sources import retail_views as rv

# name -> (operation, parameters, SQL on the source column)
_OPERATIONS = {
    "trim": ("trim", {}, "trim(source)"),
    "ltrim": ("ltrim", {}, "ltrim(source)"),
    "rtrim": ("rtrim", {}, "rtrim(source)"),
    "left": ("left", {"length": 5}, "substr(source, 1, 5)"),
    "right": ("right", {"length": 4}, "substr(source, greatest(length(source) - 3, 1), 4)"),
    "substring": ("substring", {"start": 2, "length": 4}, "substr(source, 3, 4)"),
    "upper": ("toUpperCase", {}, "upper(source)"),
    "lower": ("toLowerCase", {}, "lower(source)"),
    "replace": ("replace", {"target": "e ", "replacement": "E_"}, "replace(source, 'e ', 'E_')"),
    "regex_replace": ("regexReplace", {"regex": "[aeiou]+", "replacement": "#"},
                      "regexp_replace(source, '[aeiou]+', '#', 'g')"),
    "pad_left": ("padLeft", {"totalLength": 30, "padChar": "0"}, "lpad(source, 30, '0')"),
    "pad_right": ("padRight", {"totalLength": 12, "padChar": "xy"}, "rpad(source, 12, 'xy')"),
}
_SOURCE = "(SELECT p_partkey, '  ' || p_name || ' ' || p_brand || '  ' AS source FROM part)"


def _names(spark, sf):
    return rv.table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" "), "p_brand", F.lit("  ")).alias("source")
    )


def _config(operation: str, params: dict, dest: str = "result") -> dict[str, str]:
    config = {"stringop.operation": operation, "stringop.source.column": "source", "stringop.dest.column": dest}
    return config | {f"stringop.param.{k}": str(v) for k, v in params.items()}


def _register(label: str, operation: str, params: dict, sql: str) -> None:
    @query(
        "p_partkey bigint, source text, result text",
        f"SELECT p_partkey, source, {sql} AS result FROM {_SOURCE}",
        name=f"stringop_{label}",
    )
    def run(spark, sf):
        return apply_string_op(_names(spark, sf), _config(operation, params))


for _label, (_operation, _params, _sql) in _OPERATIONS.items():
    _register(_label, _operation, _params, _sql)


@query("p_partkey bigint, source text", f"SELECT * FROM {_SOURCE}")
def stringop_identity(spark, sf):
    """Unusable configurations change nothing."""
    names = _names(spark, sf)
    for config in (
        _config("shout", {}), _config("left", {"length": "five"}), {"stringop.operation": "trim"},
    ):
        names = apply_string_op(names, config)
    return names


@query(
    "p_partkey bigint, source text",
    f"SELECT p_partkey, lpad(upper(substr(trim(source), 1, 8)), 12, '*') AS source FROM {_SOURCE}",
)
def stringop_chain(spark, sf):
    """Several operations in a row, each replacing the column."""
    steps = [("trim", {}), ("left", {"length": 8}), ("upper", {}), ("padLeft", {"totalLength": 12, "padChar": "*"})]
    names = _names(spark, sf)
    for operation, params in steps:
        names = names.transform(string_op(_config(operation, params, "source")))
    return names


@query(
    "scan_id text, ts text, ts_default text, day text, month_start text, year bigint, month bigint, week_before text, "
    "formatted text, bad_time text",
    """SELECT scan_id, scan_ts AS ts, scan_ts AS ts_default, CAST(scan_ts AS DATE) AS day,
              CAST(date_trunc('month', scan_ts) AS TIMESTAMP) AS month_start, year(scan_ts) AS year,
              month(scan_ts) AS month, CAST(scan_ts AS DATE) - 7 AS week_before,
              strftime(scan_ts, '%Y-%m-%d %H:%M:%S') AS formatted, NULL AS bad_time
       FROM scans""",
    ["scans"],
)
def scalar_dates(spark, sf):
    ts = temporal.parse_scan_time(F.col("scan_datetime"))
    return rv.scans(spark, sf).select(
        "scan_id", ts.alias("ts"), temporal.parse_any_time(F.col("scan_datetime")).alias("ts_default"),
        temporal.scan_date(ts).alias("day"), temporal.month_start(ts).alias("month_start"),
        F.year(ts).alias("year"), F.month(ts).alias("month"),
        F.date_sub(temporal.scan_date(ts), 7).alias("week_before"),
        temporal.format_time(ts).alias("formatted"),
        temporal.parse_scan_time(F.concat(F.lit("x"), "scan_datetime")).alias("bad_time"),
    )


@query(
    "scan_id text, net_sale double, gross double, rounded double, too_large double",
    """SELECT scan_id, net_sale, unit_qty * unit_price AS gross, round(unit_qty * unit_price * 0.125, 2) AS rounded,
              CASE WHEN unit_qty = 0 THEN 0 END AS too_large
       FROM scans""",
    ["scans"],
)
def scalar_money(spark, sf):
    quantity, price = F.col("unit_qty"), F.col("unit_price")
    return rv.scans(spark, sf).select(
        "scan_id", money.net_sale(quantity, price).alias("net_sale"), money.gross(quantity, price).alias("gross"),
        F.round(quantity * price * F.lit(0.125).cast("decimal(4,3)"), 2).alias("rounded"),
        money.net_sale(quantity * 1_000_000, price).alias("too_large"),
    )


@query(
    "event_id bigint, la_date text",
    """SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS la_date FROM events""",
)
def la_today(spark, sf):
    return rv.table(spark, sf, "events").select("event_id", temporal.date_in_zone(F.col("ts")).alias("la_date"))


@query(
    "scan_id text, offset_hours bigint, local_ts text",
    """SELECT scan_id, CAST(regexp_extract(timezone, 'GMT([+-]\\d{2})', 1) AS INT) AS offset_hours,
              scan_ts + to_hours(CAST(regexp_extract(timezone, 'GMT([+-]\\d{2})', 1) AS INT)) AS local_ts
       FROM timed_scans""",
    ["timed_scans"],
)
def local_time(spark, sf):
    zone = F.col("timezone")
    return rv.timed_scans(spark, sf).select(
        "scan_id", temporal.zone_offset_hours(zone).alias("offset_hours"),
        temporal.utc_to_local(F.col("scan_ts"), zone).alias("local_ts"),
    )


@query(
    "scan_id text, in_hours boolean",
    """SELECT scan_id, CAST(scan_ts AS TIME) BETWEEN TIME '09:00:00' AND TIME '17:00:00' AS in_hours FROM timed_scans""",
    ["timed_scans"],
)
def business_hours(spark, sf):
    return rv.timed_scans(spark, sf).select(
        "scan_id", temporal.in_business_hours(F.col("scan_ts")).alias("in_hours")
    )
