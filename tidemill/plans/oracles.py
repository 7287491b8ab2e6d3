"""SQL statements (DuckDB dialect) that give the registered queries' results.

They restate the topics and the semantics from the tables alone and share no
code with the DataFrame side beyond the query names.
"""

from __future__ import annotations

USER_ACTIVITY = """
SELECT CAST(event_id AS VARCHAR) AS event_id,
       'user_' || CAST(user_id AS VARCHAR) AS user_id,
       'session_' || CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
       kind AS event_type,
       CASE WHEN kind <> 'search' THEN 'prod_' || CAST(event_id % 211 + 1 AS VARCHAR) END AS product_id,
       CASE WHEN kind = 'search' THEN 'query_' || CAST(event_id % 97 + 1 AS VARCHAR) END AS search_query,
       CASE WHEN kind = 'payment' THEN value END AS amount,
       ['kiosk', 'laptop', 'phone'][event_id % 3 + 1] AS device_type,
       ['NO', 'PT', 'CL', 'KE', 'NZ', 'TH'][user_id % 6 + 1] AS geo_country,
       (epoch_us(ts) // 1000) AS timestamp_ms,
       CAST(user_id % 3 AS INTEGER) AS "partition",
       event_id AS "offset",
       make_timestamp(((epoch_us(ts) // 1000) + 5) * 1000) AS kafka_timestamp
FROM (SELECT *, CASE event_type
                  WHEN 'view' THEN CASE WHEN event_id % 4 = 0 THEN 'review' ELSE 'product_view' END
                  WHEN 'click' THEN CASE WHEN user_id % 3 = 0 THEN 'checkout' ELSE 'add_to_cart' END
                  WHEN 'purchase' THEN 'payment'
                  WHEN 'signup' THEN 'login'
                  ELSE 'search' END AS kind
      FROM events)
"""

PRODUCT_EVENTS = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS event_id,
       'prod_' || CAST(l_partkey AS VARCHAR) AS product_id,
       kind AS event_type,
       ['Anchor', 'Bellows', 'Compass', 'Dinghy', 'Fender', 'Halyard', 'Jib'][l_partkey % 7 + 1]
         AS product_name,
       ['rigging', 'deck', 'galley', 'charts', 'safety'][l_partkey % 5 + 1] AS category,
       l_extendedprice AS price,
       CASE WHEN kind = 'price_changed' THEN l_extendedprice + l_quantity END AS previous_price,
       CAST(trunc(l_quantity) AS INTEGER) AS stock_quantity,
       CASE WHEN kind = 'stock_updated'
            THEN CAST(CAST(trunc(l_quantity) AS INTEGER) + l_linenumber AS DOUBLE) END
         AS previous_stock_quantity,
       (epoch_us(l_shipdate) // 1000) AS timestamp_ms,
       CAST(l_partkey % 2 AS INTEGER) AS "partition",
       (epoch_us(l_shipdate) // 1000) // 86400000 * 10000000 + l_suppkey AS "offset",
       make_timestamp(((epoch_us(l_shipdate) // 1000) + 5) * 1000) AS kafka_timestamp
FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 'price_changed'
                     WHEN l_returnflag = 'N' THEN 'stock_updated'
                     WHEN l_linestatus = 'F' THEN 'product_created'
                     ELSE 'product_updated' END AS kind
      FROM lineitem)
"""

ORDER_EVENTS = """
SELECT CAST(o_orderkey AS VARCHAR) AS event_id,
       'ord_' || CAST(o_orderkey AS VARCHAR) AS order_id,
       'user_' || CAST(o_custkey AS VARCHAR) AS user_id,
       kind AS event_type,
       array_to_string(['prod_' || CAST((o_orderkey * 7 + i * 31) % 211 + 1 AS VARCHAR)
                        for i in range(o_orderkey % 4 + 1)], ',') AS product_ids,
       o_totalprice AS total_amount,
       ['NOK', 'EUR', 'CLP', 'KES', 'NZD', 'THB'][o_custkey % 6 + 1] AS currency,
       ['NO', 'PT', 'CL', 'KE', 'NZ', 'TH'][o_custkey % 6 + 1] AS shipping_country,
       CASE WHEN kind = 'order_cancelled'
            THEN ['changed_mind', 'card_declined', 'lost_in_transit'][o_orderkey % 3 + 1] END AS cancellation_reason,
       (epoch_us(o_orderdate) // 1000) AS timestamp_ms,
       CAST(o_custkey % 2 AS INTEGER) AS "partition",
       o_orderkey AS "offset",
       make_timestamp(((epoch_us(o_orderdate) // 1000) + 5) * 1000) AS kafka_timestamp
FROM (SELECT *, CASE o_orderstatus
                  WHEN 'O' THEN 'order_placed'
                  WHEN 'P' THEN CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
                                     THEN 'order_confirmed' ELSE 'order_shipped' END
                  ELSE CASE WHEN o_orderpriority = '5-LOW'
                            THEN 'order_cancelled' ELSE 'order_delivered' END
                END AS kind
      FROM orders)
"""

TOPIC_SQL = {
    "user_activity": USER_ACTIVITY,
    "product_events": PRODUCT_EVENTS,
    "order_events": ORDER_EVENTS,
}

#: Halfway between the first and the last event.
_CUT = "(SELECT (min(epoch_us(ts) // 1000) + max(epoch_us(ts) // 1000)) // 2 FROM events)"


def _windows(
    topic: str,
    keys: list[str],
    aggregates: str,
    where: str = "TRUE",
    final: str | None = "matching",
    unit: str = "hour",
    delay: str = "30 MINUTE",
) -> str:
    """Windowed aggregate; ``final`` says which rows move the watermark, None keeps all."""
    names = "".join(f", {k}" for k in keys)
    outputs = [a.rsplit(" AS ", 1)[1] for a in aggregates.split(";")]
    condition = {
        None: "TRUE",
        "matching": f"window_end <= (SELECT max(tt) - INTERVAL {delay} FROM matching)",
        "all": f"window_end <= (SELECT max(tt) - INTERVAL {delay} FROM everything)",
    }[final]
    return f"""
WITH everything AS (SELECT *, make_timestamp(timestamp_ms * 1000) AS tt FROM ({TOPIC_SQL[topic]})),
matching AS (SELECT *, date_trunc('{unit}', tt) AS window_start FROM everything WHERE {where}),
grouped AS (SELECT window_start, window_start + INTERVAL 1 {unit} AS window_end{names},
                   {", ".join(aggregates.split(";"))}
            FROM matching GROUP BY window_start{names})
SELECT window_start, window_end{names}, {", ".join(outputs)} FROM grouped WHERE {condition}
"""


_JOBS = {
    "j1_funnel": ("user_activity", ["event_type"], "count(*) AS event_count"),
    "j2_revenue": (
        "user_activity",
        [],
        "round(sum(amount), 2) AS total_revenue;count(*) AS payment_count",
        "event_type = 'payment'",
    ),
    "j3_product_activity": (
        "product_events",
        ["category", "event_type"],
        "count(*) AS event_count",
    ),
    "j4_price_changes": (
        "product_events",
        ["category"],
        "round(avg(price), 6) AS avg_price;count(*) AS price_change_count",
        "event_type = 'price_changed'",
    ),
    "j5_order_metrics": ("order_events", ["event_type"], "count(*) AS order_count"),
    "j6_order_revenue": (
        "order_events",
        ["shipping_country"],
        "round(sum(total_amount), 2) AS total_revenue;count(*) AS order_count",
        "event_type = 'order_placed'",
    ),
}

_ORDERING = {
    "user_activity": (
        "user_id, session_id, event_type, product_id, search_query, amount, device_type, "
        "geo_country, timestamp_ms"
    ),
    "product_events": (
        "product_id, event_type, product_name, category, price, previous_price, "
        "stock_quantity, previous_stock_quantity, timestamp_ms"
    ),
    "order_events": (
        "order_id, user_id, event_type, product_ids, total_amount, currency, "
        "shipping_country, cancellation_reason, timestamp_ms"
    ),
}


def _deduplicated(topic: str) -> str:
    """First of two deliveries per key, by partition and offset, ties by payload."""
    ranking = ", ".join(f"{c.strip()} NULLS FIRST" for c in _ORDERING[topic].split(","))
    return f"""
WITH t AS ({TOPIC_SQL[topic]}),
deliveries AS (SELECT * FROM t
               UNION ALL
               SELECT * REPLACE ("offset" + 1000000000000 AS "offset",
                                 kafka_timestamp + INTERVAL 60 SECOND AS kafka_timestamp)
               FROM t),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id
                                        ORDER BY "partition", "offset", {ranking}) AS rn
           FROM deliveries)
SELECT * EXCLUDE (rn, "partition", "offset") FROM ranked WHERE rn = 1
"""


def _later_fields() -> str:
    return f"""
SELECT event_id, event_type, product_id, amount,
       CASE WHEN timestamp_ms >= {_CUT} THEN search_query END AS search_query,
       CASE WHEN timestamp_ms >= {_CUT} THEN device_type END AS device_type
FROM ({USER_ACTIVITY})
"""


_HEADERS = " UNION ALL ".join(
    f"SELECT '{topic}' AS topic, '00' AS magic, TRUE AS framed, "
    f"CAST({number} AS BIGINT) AS schema_id, count(*) AS messages FROM {table}"
    for topic, number, table in (
        ("user-activity", 1, "events"),
        ("product-events", 2, "lineitem"),
        ("order-events", 3, "orders"),
    )
)

_QUARANTINE = f"""
SELECT destination, detail, count(*) AS messages
FROM (SELECT CASE WHEN event_type IN ('search', 'login', 'review') THEN 'quarantine' ELSE 'bronze' END
               AS destination,
             CASE event_type WHEN 'search' THEN 'malformed_payload'
                             WHEN 'login' THEN 'bad_header'
                             WHEN 'review' THEN 'missing_key'
                             WHEN 'payment' THEN 'tombstone'
                             ELSE event_type END AS detail
      FROM ({USER_ACTIVITY}))
GROUP BY destination, detail
"""

_TWO_BATCHES = f"""
WITH t AS ({USER_ACTIVITY}),
early AS (SELECT event_id, event_type, amount, device_type, kafka_timestamp FROM t
          WHERE timestamp_ms < {_CUT}),
again AS (SELECT event_id, event_type, amount + 1 AS amount, 'changed' AS device_type,
                 kafka_timestamp + INTERVAL 60 SECOND AS kafka_timestamp FROM t)
SELECT * FROM early
UNION ALL
SELECT * FROM again WHERE NOT EXISTS (SELECT 1 FROM early WHERE early.event_id = again.event_id)
"""

_BATCH_COUNTS = f"""
WITH t AS ({PRODUCT_EVENTS}),
early AS (SELECT DISTINCT event_id FROM t WHERE event_type = 'price_changed')
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS inserted FROM early
UNION ALL
SELECT CAST(1 AS BIGINT), count(DISTINCT event_id) FROM t
WHERE NOT EXISTS (SELECT 1 FROM early WHERE early.event_id = t.event_id)
"""

_TOMBSTONES = f"""
SELECT FALSE AS without_key, count(*) AS n FROM ({USER_ACTIVITY}) WHERE event_type <> 'payment'
UNION ALL
SELECT TRUE, CAST(2 AS BIGINT)
WHERE EXISTS (SELECT 1 FROM ({USER_ACTIVITY}) WHERE event_type = 'payment')
"""


def _pipeline_counts() -> str:
    parts = []
    for topic, sql in TOPIC_SQL.items():
        parts.append(
            f"SELECT 'bronze.{topic}' AS table_name, 2 * count(*) AS row_count FROM ({sql})"
        )
        parts.append(f"SELECT 'silver.{topic}', count(*) FROM ({_deduplicated(topic)})")
    names = {
        "j1_funnel": "funnel_metrics_hourly",
        "j2_revenue": "revenue_hourly",
        "j3_product_activity": "product_activity_hourly",
        "j4_price_changes": "price_changes_hourly",
        "j5_order_metrics": "order_metrics_hourly",
        "j6_order_revenue": "order_revenue_hourly",
    }
    for prefix, name in names.items():
        topic = _JOBS[prefix][0]
        final = _windows(*_JOBS[prefix]).replace(TOPIC_SQL[topic], _deduplicated(topic))
        parts.append(f"SELECT 'gold.{name}', count(*) FROM ({final})")
    return " UNION ALL ".join(parts)


def _quality(filled: bool) -> str:
    rules = [
        ("user_activity", "product_id null iff search", "event_type = 'search'", "product_id"),
        ("user_activity", "search_query set iff search", "event_type <> 'search'", "search_query"),
        ("user_activity", "amount set iff payment", "event_type <> 'payment'", "amount"),
        (
            "product_events",
            "previous_price set iff price_changed",
            "event_type <> 'price_changed'",
            "previous_price",
        ),
        (
            "product_events",
            "previous_stock_quantity set iff stock_updated",
            "event_type <> 'stock_updated'",
            "previous_stock_quantity",
        ),
        (
            "order_events",
            "cancellation_reason set iff order_cancelled",
            "event_type <> 'order_cancelled'",
            "cancellation_reason",
        ),
    ]
    # Where a column must be NULL, filling it breaks the rule.
    return " UNION ALL ".join(
        f"SELECT '{topic}' AS topic, '{rule}' AS rule, count(*) AS rows_checked, "
        + (
            f"count(*) FILTER (WHERE {must_be_null}) AS violations "
            if filled
            else f"count(*) FILTER (WHERE ({must_be_null}) <> ({column} IS NULL)) AS violations "
        )
        + f"FROM ({TOPIC_SQL[topic]})"
        for topic, rule, must_be_null, column in rules
    )


_QUARANTINE_BY_ID = f"""
SELECT CASE WHEN event_type = 'login' THEN 'unknown_schema' ELSE 'accepted' END AS verdict,
       CASE WHEN event_type <> 'login' THEN event_type END AS event_type,
       count(*) AS messages,
       count(CASE WHEN event_type NOT IN ('login', 'search') THEN device_type END) AS devices
FROM ({USER_ACTIVITY}) t GROUP BY ALL
"""


def oracle_statements() -> dict[str, str]:
    found: dict[str, str] = {}
    for prefix, job in _JOBS.items():
        where = job[3] if len(job) > 3 else "TRUE"
        found[f"{prefix}_hourly"] = _windows(*job)
        found[f"{prefix}_batch"] = _windows(*job[:3], where, final=None)
    for prefix in ("j2_revenue", "j4_price_changes", "j6_order_revenue"):
        found[f"{prefix}_watermark_all"] = _windows(*_JOBS[prefix], final="all")
    found["j6_order_revenue_daily"] = _windows(
        *_JOBS["j6_order_revenue"], unit="day", delay="2 DAY"
    )
    found["gold_resume"] = _windows(*_JOBS["j1_funnel"])
    found["gold_late_dropped"] = _windows(*_JOBS["j1_funnel"], f"timestamp_ms >= {_CUT}")
    found["gold_compacted"] = _windows(*_JOBS["j1_funnel"])
    for topic, sql in TOPIC_SQL.items():
        found[f"bronze_decode_{topic}"] = sql
    found["header_schema_id"] = _HEADERS
    found["decode_by_schema_id"] = _later_fields()
    found["bronze_additive_schema"] = _later_fields()
    found["bronze_new_schema_id"] = _later_fields()
    found["silver_additive_columns"] = _later_fields()
    found["silver_recovered"] = (
        f"SELECT event_id, event_type, amount, kafka_timestamp FROM ({USER_ACTIVITY}) t"
    )
    found["bronze_late_files"] = (
        'SELECT event_id, event_type, total_amount, "partition", "offset" '
        f"FROM ({TOPIC_SQL['order_events']}) t"
    )
    found["quarantine"] = _QUARANTINE
    found["quarantine_by_schema_id"] = _QUARANTINE_BY_ID
    for topic in TOPIC_SQL:
        found[f"silver_dedup_{topic}"] = _deduplicated(topic)
    found["silver_two_batches"] = _TWO_BATCHES
    found["silver_two_batches_bucketed"] = _TWO_BATCHES
    found["silver_batch_counts"] = _BATCH_COUNTS
    found["silver_tombstones"] = _TOMBSTONES
    found["pipeline_end_to_end"] = _pipeline_counts()
    found["pipeline_resumed"] = _pipeline_counts()
    found["quality_invariants"] = _quality(filled=False)
    found["quality_violations"] = _quality(filled=True)
    return found
