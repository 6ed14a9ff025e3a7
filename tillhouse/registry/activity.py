"""Store activity, running totals, weights, draws and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.temporal import clock_text, format_time, utc_to_local
from tillhouse.functions.traffic import expected_scans, load_multiplier
from tillhouse.operators import activity, sampling, totals
from tillhouse.registry.core import query
from tillhouse.sources import retail_views as rv


@query("store_id bigint, timezone text", "SELECT store_id, timezone FROM stores WHERE timezone = 'MST (GMT-07)'", ["stores"])
def zone_partition(spark, sf):
    return activity.stores_in_zone(rv.stores(spark, sf), "MST (GMT-07)")


@query("timezone text", "SELECT DISTINCT timezone FROM stores", ["stores"])
def distinct_timezones(spark, sf):
    return activity.distinct_timezones(rv.stores(spark, sf))


@query("timezone text, store_count bigint", "SELECT timezone, count(*) AS store_count FROM stores GROUP BY ALL", ["stores"])
def stores_per_timezone(spark, sf):
    return activity.stores_per_timezone(rv.stores(spark, sf))


@query(
    "scan_id text, multiplier double, expected bigint",
    """SELECT scan_id, multiplier,
              CAST(trunc(floor(multiplier * (8000 / CAST(60 AS DOUBLE))) * CASE WHEN timezone IN ('HST (GMT-10)', 'AKST (GMT-09)')
                   THEN CAST(0.4 AS DOUBLE) WHEN timezone = 'MST (GMT-07)' THEN CAST(0.8 AS DOUBLE)
                   ELSE CAST(1 AS DOUBLE) END) AS INT) AS expected
       FROM (SELECT scan_id, timezone, CAST(CASE hour(local_ts) WHEN 10 THEN 0.12 WHEN 11 THEN 1 WHEN 12 THEN 1
                        WHEN 13 THEN 0.25 WHEN 14 THEN 0.25 WHEN 15 THEN 0.25
                        WHEN 16 THEN 0.75 WHEN 17 THEN 0.75 WHEN 18 THEN 0.75
                        WHEN 19 THEN 0.17 WHEN 20 THEN 0.17 WHEN 21 THEN 0.17 ELSE 0 END AS DOUBLE) AS multiplier
             FROM (SELECT scan_id, timezone, scan_ts
                          + to_hours(CAST(regexp_extract(timezone, 'GMT([+-]\\d{2})', 1) AS INT)) AS local_ts
                   FROM timed_scans))""",
    ["timed_scans"],
)
def expected_load(spark, sf):
    local = utc_to_local(F.col("scan_ts"), F.col("timezone"))
    return rv.timed_scans(spark, sf).select(
        "scan_id", load_multiplier(F.hour(local)).alias("multiplier"),
        expected_scans(local, F.col("timezone")).alias("expected"),
    )


_RECORD_LENGTH = """length('{"scan_id":"' || scan_id || '","store_id":' || store_id || ',"scan_datetime":"' || scan_datetime
    || '","item_upc":"' || item_upc || '","unit_qty":' || unit_qty || ',"unit_price":' || unit_price || '}')"""


@query(
    "timezone text, batch_count bigint, data_volume bigint",
    f"SELECT timezone, count(*) AS batch_count, sum({_RECORD_LENGTH}) AS data_volume FROM timed_scans GROUP BY ALL",
    ["timed_scans"],
)
def activity_summary(spark, sf):
    return activity.activity_summary(rv.timed_scans(spark, sf))


@query(
    "timezone text, minute text, batch_count bigint, void_count bigint, data_volume bigint",
    f"""SELECT timezone, date_trunc('minute', scan_ts) AS minute, count(*) AS batch_count,
               count(*) FILTER (WHERE unit_qty = 0) AS void_count, sum({_RECORD_LENGTH}) AS data_volume
        FROM timed_scans GROUP BY ALL""",
    ["timed_scans"],
)
def minute_batches(spark, sf):
    return activity.minute_batches(rv.timed_scans(spark, sf))


def message_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as numbered activity messages; dear ones are torn, views are of unknown type."""
    kind = F.col("event_type")
    events = rv.table(spark, sf, "events")
    line = F.to_json(F.struct(
        F.when(kind == "signup", "start").when(kind == "error", "stop").when(kind == "view", "heartbeat")
        .otherwise("scans").alias("type"),
        rv.timezone_of(F.col("user_id")).alias("timezone"),
        format_time(F.col("ts")).alias("timestamp"),
        clock_text(F.col("ts")).alias("localTime"),
        (F.get_json_object("props", "$.k").cast("bigint") + 1).alias("batchCount"),
        F.col("user_id").alias("dataVolume"),
    ))
    torn = F.col("value").cast("decimal(8,2)") >= 50
    return events.select(
        F.col("event_id").alias("seq"),
        F.when(torn, F.substring(line, F.lit(1), F.length(line) - 3)).otherwise(line).alias("value"),
    )


def good_messages(spark: SparkSession, sf: str) -> DataFrame:
    return activity.read_messages(message_lines(spark, sf)).where(F.col("problem").isNull())


ZONE_STATE = (
    "timezone text, is_running boolean, local_time text, last_batch_time text, last_batch_count bigint, "
    "cumulative_count bigint, data_volume bigint"
)
ZONE_STATE_SQL = """
    WITH known AS (SELECT timezone, min(seq) AS since FROM good_messages WHERE type IN ('start', 'scans') GROUP BY ALL),
         applied AS (SELECT g.* FROM good_messages g JOIN known k ON g.timezone = k.timezone AND g.seq >= k.since)
    SELECT timezone,
           coalesce(arg_max(type, seq) FILTER (WHERE type IN ('start', 'stop')), 'start') = 'start' AS is_running,
           arg_max(local_time, seq) AS local_time,
           arg_max(stamp, seq) FILTER (WHERE type = 'scans') AS last_batch_time,
           arg_max(batch_count, seq) FILTER (WHERE type = 'scans') AS last_batch_count,
           coalesce(sum(batch_count) FILTER (WHERE type = 'scans'), 0) AS cumulative_count,
           coalesce(sum(data_volume) FILTER (WHERE type = 'scans'), 0) AS data_volume
    FROM applied GROUP BY timezone"""


@query(ZONE_STATE, ZONE_STATE_SQL, ["good_messages"])
def activity_state(spark, sf):
    return activity.zone_state(good_messages(spark, sf), F.col("seq"))


@query(
    "total_transactions bigint, total_data_volume bigint",
    """SELECT sum(batch_count) AS total_transactions, sum(data_volume) AS total_data_volume
       FROM good_messages WHERE type = 'scans'""",
    ["good_messages"],
)
def activity_totals(spark, sf):
    return activity.grand_totals(good_messages(spark, sf))


@query(
    "minute text, timezone text, batch_count bigint, running_total bigint",
    """SELECT minute, timezone, batch_count, sum(batch_count) OVER (ORDER BY minute, timezone) AS running_total
       FROM minutes""",
    ["minutes"],
)
def running_total(spark, sf):
    return activity.running_batches(rv.timed_scans(spark, sf))


@query(
    "minute text, timezone text, batch_count bigint, running_total bigint",
    """SELECT minute, timezone, batch_count,
              sum(batch_count) OVER (PARTITION BY timezone ORDER BY minute) AS running_total FROM minutes""",
    ["minutes"],
)
def running_total_per_zone(spark, sf):
    return activity.running_batches(rv.timed_scans(spark, sf), per_zone=True)


def weights(spark: SparkSession, sf: str) -> DataFrame:
    catalogue = rv.items(spark, sf).where(F.col("item_id") < rv.MADE_UP_FROM)
    return totals.cumulative_weights(catalogue)


@query(
    "item_id bigint, _frequency bigint, cum_before bigint, cum_weight bigint",
    "SELECT item_id, _frequency, cum_before, cum_weight FROM weights", ["weights"],
)
def cumulative_weights(spark, sf):
    return weights(spark, sf)


@query("total_weight bigint", "SELECT sum(_frequency) AS total_weight FROM items", ["items"])
def total_weight(spark, sf):
    return totals.total_weight(rv.items(spark, sf))


def drawn(spark: SparkSession, sf: str) -> DataFrame:
    weighted = weights(spark, sf)
    total = totals.total_weight(rv.items(spark, sf).where(F.col("item_id") < rv.MADE_UP_FROM)).scalar()
    draws = rv.table(spark, sf, "events").select("event_id", (F.col("event_id") * 7919 % total + 1).alias("draw"))
    return sampling.pick_by_weight(draws, weighted)


@query("event_id bigint, item_id bigint", "SELECT event_id, item_id FROM draws", ["draws"])
def weighted_draw(spark, sf):
    return drawn(spark, sf)


@query(
    "category_code bigint, drawn_share double, weight_share double",
    """SELECT category_code, drawn_share, weight_share
       FROM (SELECT category_code, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM draws) AS drawn_share
             FROM draws GROUP BY ALL)
       JOIN (SELECT category_code, CAST(sum(_frequency) AS DOUBLE) / (SELECT sum(_frequency) FROM weights) AS weight_share
             FROM weights GROUP BY ALL) USING (category_code)""",
    ["draws"],
)
def frequency_share(spark, sf):
    """Shares of the categories among weighted draws and among the weights."""
    shares = sampling.value_shares(drawn(spark, sf), "category_code")
    catalogue = rv.items(spark, sf).where(F.col("item_id") < rv.MADE_UP_FROM)
    expected = sampling.weight_shares(catalogue, "category_code")
    return shares.join(expected, "category_code").select(
        "category_code", F.col("share").alias("drawn_share"), "weight_share"
    )


@query(
    "latitude double, longitude double",
    """SELECT round(avg(s_acctbal), 4) AS latitude, round(avg(s_nationkey), 4) AS longitude FROM supplier""",
)
def store_centroid(spark, sf):
    """Two numeric columns stand in for the coordinates."""
    center = activity.centroid(rv.table(spark, sf, "supplier"), "s_acctbal", "s_nationkey")
    return center.select(F.round("latitude", 4).alias("latitude"), F.round("longitude", 4).alias("longitude"))


@query(
    "item_id bigint, upc_code text, category_code bigint",
    """SELECT item_id, upc_code, category_code FROM items
       WHERE category_code = (SELECT category_code FROM categories ORDER BY md5('11|' || category_code) LIMIT 1)
       ORDER BY md5('12|' || item_id) LIMIT 40""",
    ["items", "categories"],
)
def random_items(spark, sf):
    """Random items of a random category, as chosen for a price update."""
    category = sampling.random_row(rv.categories(spark, sf), 11, F.col("category_code")).select("category_code")
    items = rv.items(spark, sf).join(F.broadcast(category), "category_code")  # one row
    return sampling.random_rows(items, 40, 12, F.col("item_id"))


@query(
    "item_id bigint, category_code bigint",
    """SELECT item_id, category_code FROM items
       QUALIFY row_number() OVER (PARTITION BY category_code ORDER BY md5('13|' || item_id)) <= 5""",
    ["items"],
)
def random_items_per_category(spark, sf):
    """Five random items of every category, drawn from two halves of the table and merged."""
    items, key = rv.items(spark, sf), F.col("item_id")
    halves = [sampling.random_rows_per_group(part, ["category_code"], 5, 13, key) for part in (items.where("case_qty < 20"), items.where("case_qty >= 20"))]
    return sampling.random_rows_per_group(halves[0].unionByName(halves[1]), ["category_code"], 5, 13, key)


@query(
    "p_partkey bigint, category_code bigint, category_name text",
    """SELECT p_partkey, 20000 + 10 * CAST(substr(p_brand, 7) AS BIGINT) AS category_code, p_name AS category_name FROM part
       WHERE ('0x' || substr(md5('7|' || p_partkey), 1, 13))::BIGINT < CAST(floor(0.3::DOUBLE * 4503599627370496) AS BIGINT)""",
)
def bernoulli_sample(spark, sf):
    part = rv.table(spark, sf, "part")
    return sampling.coin_sample(part, 0.3, 7, F.col("p_partkey")).select(
        "p_partkey", rv.category_code().alias("category_code"), F.col("p_name").alias("category_name")
    )
