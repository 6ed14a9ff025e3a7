"""The retail views over the test tables as SQL, for the checks only."""

from __future__ import annotations

from collections.abc import Sequence

from tillhouse.sources.retail_views import MADE_UP_FROM, MADE_UP_SIZE

_ITEM_ID = f"CASE WHEN p_size > {MADE_UP_SIZE} THEN p_partkey + {MADE_UP_FROM} ELSE p_partkey END"

# name -> (views it builds on, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "categories": ((), """
        SELECT DISTINCT 20000 + 10 * CAST(substr(p_brand, 7) AS BIGINT) AS category_code, p_brand AS category_name
        FROM part"""),
    "items": ((), f"""
        SELECT 20000 + 10 * CAST(substr(p_brand, 7) AS BIGINT) AS category_code, {_ITEM_ID} AS item_id,
               TRY_CAST(p_retailprice AS DECIMAL(10,2)) AS base_price,
               lpad(CAST(p_partkey AS VARCHAR), 11, '0') AS upc_code, p_size AS case_qty, p_size AS _frequency
        FROM part"""),
    "stores": ((), """
        SELECT s_suppkey AS store_id, n_name AS city, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state,
               r_name AS region,
               CASE r_name WHEN 'AFRICA' THEN 'EST (GMT-05)' WHEN 'AMERICA' THEN 'CST (GMT-06)'
                    WHEN 'ASIA' THEN 'MST (GMT-07)' WHEN 'EUROPE' THEN 'PST (GMT-08)'
                    ELSE 'HST (GMT-10)' END AS timezone
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "scans": ((), """
        SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                         CAST(l_suppkey AS VARCHAR), CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS scan_id,
               concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS version_key,
               l_suppkey AS store_id,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || ' 00:00:00' AS scan_datetime,
               CAST(l_shipdate AS TIMESTAMP) AS scan_ts,
               lpad(CAST(l_partkey AS VARCHAR), 11, '0') AS item_upc,
               CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS INT) AS unit_qty,
               CAST(l_extendedprice AS DECIMAL(8,2)) AS unit_price,
               CAST(CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS INT)
                    * CAST(l_extendedprice AS DECIMAL(8,2)) AS DECIMAL(10,2)) AS net_sale,
               l_linestatus, l_returnflag
        FROM lineitem"""),
    "timed_scans": ((), """
        SELECT CAST(event_id AS VARCHAR) AS scan_id, event_id, user_id AS store_id, ts AS scan_ts,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS scan_datetime,
               lpad(json_extract_string(props, '$.k'), 11, '0') AS item_upc,
               CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS unit_qty,
               CAST(value AS DECIMAL(8,2)) AS unit_price,
               CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END * CAST(value AS DECIMAL(8,2)) AS DECIMAL(10,2))
                   AS net_sale,
               CASE user_id % 6 WHEN 0 THEN 'EST (GMT-05)' WHEN 1 THEN 'CST (GMT-06)' WHEN 2 THEN 'MST (GMT-07)'
                    WHEN 3 THEN 'PST (GMT-08)' WHEN 4 THEN 'AKST (GMT-09)' ELSE 'HST (GMT-10)' END AS timezone,
               event_type
        FROM events"""),
    "dimension": (("items", "categories"), f"""
        SELECT item_id, upc_code AS item_upc, base_price, category_code, category_name
        FROM items JOIN categories USING (category_code) WHERE item_id < {MADE_UP_FROM}"""),
    "detail": (("scans", "stores", "dimension"), """
        SELECT s.scan_id, s.store_id, s.scan_ts AS scan_timestamp, CAST(s.scan_ts AS DATE) AS scan_datestamp,
               s.item_upc, s.unit_qty, s.unit_price, s.net_sale, d.item_id, d.category_code, d.category_name,
               t.city, t.state, t.region
        FROM scans s JOIN stores t ON s.store_id = t.store_id JOIN dimension d ON s.item_upc = d.item_upc"""),
    "timed_detail": (("timed_scans", "stores", "dimension"), """
        SELECT s.scan_id, s.store_id, s.scan_ts AS scan_timestamp, CAST(s.scan_ts AS DATE) AS scan_datestamp,
               s.item_upc, s.unit_qty, s.unit_price, s.net_sale, d.item_id, d.category_code, d.category_name,
               t.city, t.state, t.region, s.event_type
        FROM timed_scans s JOIN stores t ON s.store_id = t.store_id JOIN dimension d ON s.item_upc = d.item_upc"""),
    "changes": ((), f"""
        SELECT {_ITEM_ID} AS item_id, 'U' AS op,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 1.05 AS DECIMAL(10,2)) AS base_price, 1 AS seq FROM part
        UNION ALL
        SELECT {_ITEM_ID}, 'D', CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 1.05 AS DECIMAL(10,2)), 2
        FROM part WHERE p_type IN ('PROMO', 'SMALL')
        UNION ALL
        SELECT {_ITEM_ID}, 'I', CAST(1.00 AS DECIMAL(10,2)), 3 FROM part WHERE p_type = 'SMALL'
        UNION ALL
        SELECT p_partkey + {2 * MADE_UP_FROM}, 'I', CAST(1.00 AS DECIMAL(10,2)), 1 FROM part WHERE p_type = 'LARGE'"""),
    "changed_items": (("items", "changes"), """
        SELECT item_id, upc_code, category_code, base_price FROM items
        WHERE item_id NOT IN (SELECT item_id FROM changes)
        UNION ALL
        SELECT c.item_id, i.upc_code, i.category_code, c.base_price
        FROM (SELECT item_id, arg_max(op, seq) AS op, arg_max(base_price, seq) AS base_price, bool_and(op = 'U') AS updated
              FROM changes GROUP BY item_id) c
        LEFT JOIN items i ON i.item_id = c.item_id AND c.updated
        WHERE c.op <> 'D'"""),
    "minutes": (("timed_scans",), """
        SELECT timezone, date_trunc('minute', scan_ts) AS minute, count(*) AS batch_count,
               count(*) FILTER (WHERE unit_qty = 0) AS void_count, sum(unit_qty) AS units
        FROM timed_scans GROUP BY ALL"""),
    "messages": (("timed_scans",), """
        SELECT event_id AS seq,
               CASE event_type WHEN 'signup' THEN 'start' WHEN 'error' THEN 'stop' WHEN 'view' THEN 'heartbeat'
                    ELSE 'scans' END AS type,
               timezone, scan_datetime AS stamp, substr(scan_datetime, 12, 8) AS local_time,
               CAST(item_upc AS BIGINT) + 1 AS batch_count, store_id AS data_volume,
               unit_price >= 50 AS torn
        FROM timed_scans"""),
    "good_messages": (("messages",), """
        SELECT * FROM messages WHERE NOT torn AND type <> 'heartbeat'"""),
    "heard": (("good_messages",), """
        SELECT * FROM good_messages
        WHERE NOT (timezone IN ('AKST (GMT-09)', 'HST (GMT-10)') AND stamp >= '2024-01-20 00:00:00')"""),
    "weights": (("items",), f"""
        SELECT *, sum(_frequency) OVER (ORDER BY item_id) AS cum_weight,
               sum(_frequency) OVER (ORDER BY item_id) - _frequency AS cum_before
        FROM items WHERE item_id < {MADE_UP_FROM}"""),
    "draws": (("weights", "timed_scans"), """
        SELECT e.event_id, w.item_id, w.category_code
        FROM (SELECT event_id, event_id * 7919 % (SELECT sum(_frequency) FROM weights) + 1 AS draw FROM timed_scans) e
        ASOF JOIN weights w ON e.draw > w.cum_before"""),
    "learning_rows": ((), """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE)) AS row_id,
               l_quantity, l_extendedprice, CAST(l_returnflag = 'R' AS INT) AS target,
               ('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                             CAST(l_shipdate AS DATE))), 1, 8))::BIGINT % 100 < 70 AS in_train
        FROM lineitem"""),
}


def with_views(names: Sequence[str]) -> str:
    """A WITH clause for the named views and all they build on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in VIEWS[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return ""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in ordered) + "\n"
