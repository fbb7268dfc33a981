"""SQL over the given tables that each registered query must agree with."""

from __future__ import annotations

MONEY = "DECIMAL(18,5)"
SUM = "DECIMAL(28,5)"
LARGE = "value >= 250"

COUNTER = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
ISO = "strftime({}, '%Y-%m-%d')".format

# Report rows with their final types, one per event.
REPORT = f"""
    event_type AS account_id,
    'https://example.com/ad/' || user_id AS ad_creative_instagram_permalink_url,
    CAST(user_id AS VARCHAR) AS ad_id,
    'ad ' || user_id AS ad_name,
    'set-' || event_type AS adset_id,
    upper(event_type) AS adset_name,
    'all' AS campaign_id,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date_start,
    ts AS execution_date,
    '7d_click' AS attribution_model,
    event_type || ' account' AS account_name,
    'USD' AS account_currency,
    'event ' || event_id AS campaign_name,
    {COUNTER} AS clicks,
    CAST(event_id AS {MONEY}) AS impressions,
    CASE WHEN event_type = 'purchase' THEN CAST(value AS {MONEY}) END AS purchases,
    CASE WHEN event_type <> 'purchase' THEN CAST(value AS {MONEY}) END AS custom_value,
    CAST(value AS {MONEY}) AS spend
"""
PARTITION = """
    event_type AS account,
    CAST(year(ts) AS VARCHAR) AS year,
    CAST(month(ts) AS VARCHAR) AS month,
    CAST(day(ts) AS VARCHAR) AS day
"""
CURATED = f"""
    SELECT {REPORT}, {PARTITION} FROM events
    QUALIFY row_number() OVER (
        PARTITION BY event_type, user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC
    ) = 1
"""
TOUCHED = f"""
    SELECT {REPORT}, {PARTITION} FROM events
    WHERE (event_type, CAST(ts AS DATE)) IN (
        SELECT (event_type, CAST(ts AS DATE)) FROM events WHERE {LARGE}
    )
"""
ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

AFFILIATE = f"""
    SELECT {ISO("o_orderdate")} AS date,
        o_orderpriority AS brand,
        'customer ' || o_custkey AS publisher,
        o_orderstatus AS publisher_type,
        CAST(o_custkey AS INTEGER) AS clicks,
        CAST(o_totalprice AS {MONEY}) AS revenue_gross,
        1 AS orders_gross,
        CAST(o_totalprice AS {MONEY}) AS commission_gross,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS {MONEY}) END AS commission_net,
        CAST(o_totalprice AS {MONEY}) AS spend_net,
        CAST(o_totalprice AS {MONEY}) AS spend_gross,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS execution_date
    FROM orders
"""


def daily(day: str, amount: str, source: str, label: str) -> str:
    return f"""
        SELECT {ISO(day)} AS day, CAST(SUM(CAST({amount} AS {MONEY})) AS {SUM}) AS {label}
        FROM {source} GROUP BY 1
    """


VIDEO = daily("o_orderdate", "o_totalprice", "orders", "video")
AUDIO = daily("l_shipdate", "l_extendedprice", "lineitem", "audio")
LINEAR = daily("ts", "value", "events", "linear")
MEDIA = f"""
    SELECT COALESCE(v.day, a.day) AS day, video, audio
    FROM ({VIDEO}) v FULL JOIN ({AUDIO}) a ON v.day = a.day
"""


# Breakdown columns per report, over events joined with their user and nation.
BREAKDOWNS = {
    "country": "n_name",
    "adset": "'all'",
    "age_gender": f"CAST({COUNTER} // 10 AS VARCHAR)",
    "device_platform": "CASE WHEN hour(ts) < 12 THEN 'desktop' ELSE 'mobile' END",
    "dma": "c_mktsegment",
    "hourly_advertiser_tz": "hour(ts)",
    "publisher_platform": "CASE WHEN value < 10 THEN 'feed' WHEN value < 50 THEN 'story' ELSE 'search' END",
    "region": "r_name",
}
FAMILY = """
    events LEFT JOIN customer ON user_id = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
"""


def newest(breakdown: str) -> str:
    return f"""
        SELECT *, {breakdown} AS breakdown FROM {FAMILY}
        QUALIFY row_number() OVER (
            PARTITION BY event_type, user_id, CAST(ts AS DATE), {breakdown}
            ORDER BY ts DESC, event_id DESC
        ) = 1
    """


def monitoring(report: str, rows: str) -> str:
    return f"""
        SELECT '{report}' AS report, event_type AS account, {ISO("CAST(ts AS DATE)")} AS day,
            COUNT(*) AS row_count,
            CAST(MAX(CAST(ts AS DATE)) AS TIMESTAMP) AS last_date_start,
            MAX(ts) AS last_execution_date,
            CAST(SUM(CAST(value AS {MONEY})) AS {SUM}) AS spend,
            COUNT(*) FILTER (WHERE {COUNTER} IS NULL) AS null_clicks,
            COUNT(*) FILTER (WHERE event_type <> 'purchase') AS null_purchases
        FROM {rows} GROUP BY event_type, CAST(ts AS DATE)
    """


def mart(columns: str, rows: str, group: str) -> str:
    return f"""
        SELECT {columns}, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date_start,
            CAST(SUM({COUNTER}) AS BIGINT) AS clicks,
            CAST(SUM(CAST(event_id AS {MONEY})) AS {SUM}) AS impressions,
            CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS {MONEY}) END) AS {SUM}) AS purchases,
            CAST(SUM(CASE WHEN event_type <> 'purchase' THEN CAST(value AS {MONEY}) END) AS {SUM}) AS custom_value,
            CAST(SUM(CAST(value AS {MONEY})) AS {SUM}) AS spend
        FROM {rows} GROUP BY {group}, CAST(ts AS DATE)
    """


EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"
MONDAY = "CAST(date_trunc('week', {0}) AS DATE)".format

ORACLE = {
    "curate_events": CURATED,
    "curation_counts": """
        WITH keyed AS (
            SELECT event_type, user_id, CAST(ts AS DATE) AS d, hour(ts) < 12 AS early FROM events
        )
        SELECT 'am' AS delivery, COUNT(*) AS rows_read,
            COUNT(DISTINCT (event_type, user_id, d)) AS rows_written
        FROM keyed WHERE early
        UNION ALL
        SELECT 'pm', (SELECT COUNT(*) FROM keyed WHERE NOT early),
            COUNT(DISTINCT (event_type, user_id, d))
        FROM keyed WHERE (event_type, d) IN (SELECT (event_type, d) FROM keyed WHERE NOT early)
    """,
    "upsert_out_of_order": CURATED,
    "upsert_idempotent": CURATED,
    "catalog_upsert": CURATED,
    "curate_versioned": CURATED,
    "curate_bucketed": CURATED,
    "incremental_files": CURATED,
    "scan_recursive_csv": f"SELECT {EVENT_COLUMNS} FROM events",
    "scan_header_groups": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
            CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority
        FROM orders
    """,
    "scan_quoted_csv": r"""
        SELECT source, id,
            ' "' || replace(replace(regexp_replace(text, '[\r\n]', ' ', 'g'), 'e ', 'e", '), 'n ', 'n\ ') || '\" ' AS text,
            9 AS "after"
        FROM (
            SELECT 'documents' AS source, CAST(doc_id AS VARCHAR) AS id, text FROM documents
            UNION ALL SELECT 'conversations', CAST(conv_id AS VARCHAR), text FROM conversations
        )
    """,
    "scan_multiline_csv": """
        SELECT 'documents' AS source, CAST(doc_id AS VARCHAR) AS id, text, 9 AS "after" FROM documents
        UNION ALL SELECT 'conversations', CAST(conv_id AS VARCHAR), text, 9 FROM conversations
    """,
    "scan_mixed_headers": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
            CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderpriority END AS o_orderpriority
        FROM orders
    """,
    "keep_latest_lineitem": """
        SELECT * FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC
        ) = 1
    """,
    "latest_document_by_text": """
        SELECT * FROM documents
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) = 1
    """,
    "union_by_name_orders": f"SELECT {ORDER_COLUMNS} FROM orders",
    "touched_partitions": TOUCHED,
    "partition_keys": f"SELECT DISTINCT {PARTITION} FROM events",
    "dirty_filter": f"""
        SELECT {REPORT} FROM events WHERE event_type <> 'error' AND hour(ts) <> 13
    """,
    "typed_metrics": f"""
        SELECT event_id,
            CASE WHEN {COUNTER} >= 90 THEN -1
                 WHEN {COUNTER} BETWEEN 70 AND 79
                 THEN COALESCE(TRY_CAST({COUNTER} || '000000000' AS INTEGER), -1)
                 ELSE {COUNTER} END AS clicks,
            {COUNTER} >= 90 OR ({COUNTER} BETWEEN 70 AND 79
                AND TRY_CAST({COUNTER} || '000000000' AS INTEGER) IS NULL) OR {COUNTER} IS NULL AS clicks_missing,
            CASE WHEN hour(ts) IN (0, 1) THEN NULL ELSE CAST(value AS {MONEY}) END AS spend,
            CASE WHEN hour(ts) <> 2 THEN ts END AS execution_date
        FROM events
    """,
    "cast_doubles": """
        SELECT l_orderkey, l_linenumber,
            CAST(trunc(CAST(o_totalprice AS DOUBLE) * 1000) AS INTEGER) AS large,
            CAST(trunc(CAST(l_discount AS DOUBLE) / 1000) AS INTEGER) AS small
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "mapping_lineitem": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_key,
            l_linenumber AS line_number,
            CAST(l_quantity AS INTEGER) AS quantity,
            CAST(l_extendedprice AS {MONEY}) AS price,
            CAST(l_discount AS {MONEY}) AS discount,
            l_returnflag AS return_flag, l_linestatus AS line_status, l_shipdate AS shipped
        FROM lineitem
    """,
    "rename_orders": """
        SELECT o_orderkey AS order_key, o_custkey, o_orderstatus AS status, o_totalprice,
            o_orderdate, o_orderpriority
        FROM orders
    """,
    "constants_and_copies": """
        SELECT event_type AS account, 'web' AS platform, 'events' AS type, event_id, user_id
        FROM events
    """,
    "dotted_columns": f"""
        SELECT campaign_name, purchases, custom_value, spend FROM (SELECT {REPORT} FROM events)
    """,
    "warehouse_append": f"{AFFILIATE} UNION ALL {AFFILIATE}",
    "warehouse_replayed": AFFILIATE,
    "warehouse_new_files": AFFILIATE,
    "daily_media_spend": f"""
        SELECT {ISO("ts")} AS day, event_type AS medium,
            CAST(SUM(CAST(value AS {MONEY})) AS {SUM}) AS spend
        FROM events GROUP BY 1, 2
    """,
    "map_flatten": f"""
        SELECT {ISO("ts")} AS day, event_type AS medium,
            CAST(SUM(CAST(value AS {MONEY})) AS {SUM}) AS spend
        FROM events GROUP BY 1, 2
    """,
    "array_flatten": f"""
        SELECT {ISO("ts")} AS day, CAST(SUM(CAST(value AS {MONEY})) AS {SUM}) AS spend
        FROM events GROUP BY 1
    """,
    "props_flatten": f"SELECT event_id, 'k' AS name, {COUNTER} AS number FROM events",
    "completeness": f"""
        SELECT user_id || '/' || {ISO("ts")} AS document,
            CAST(COUNT(DISTINCT event_type) AS INTEGER) AS keys_found,
            COUNT(DISTINCT event_type) = 5 AS complete
        FROM events GROUP BY 1
    """,
    "media_outer_join": MEDIA,
    "media_outer_join_hot": MEDIA,
    "spend_summary": f"""
        SELECT COALESCE(s.day, l.day) AS day, video, audio, linear
        FROM ({MEDIA}) s FULL JOIN ({LINEAR}) l ON s.day = l.day
    """,
    "spend_summary_redelivered": f"""
        SELECT COALESCE(s.day, l.day) AS day, video, audio, linear
        FROM ({MEDIA}) s FULL JOIN ({LINEAR}) l ON s.day = l.day
    """,
    "sorted_export": f"""
        SELECT {ISO("o_orderdate")} AS day,
            CAST(SUM(CAST(o_totalprice AS {MONEY})) AS {SUM}) AS total
        FROM orders GROUP BY 1
    """,
    "landing_layout": """
        SELECT DISTINCT 'media/spend_summary/year=' || year(o_orderdate)
                || '/month=' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')
                || '/day=' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0')
                || '/' || strftime(o_orderdate, '%Y-%m-%d') || '.csv' AS object_name,
            strftime(o_orderdate, '%Y-%m-%d') || '.csv' AS file_name
        FROM orders
    """,
    "landing_roundtrip": """
        SELECT event_id, event_type, ts,
            strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
        FROM events
    """,
    "landing_undated": """
        SELECT event_id, event_type, t AS ts, strftime(t, '%Y') AS year, strftime(t, '%m') AS month, strftime(t, '%d') AS day
        FROM (SELECT *, CASE WHEN event_type <> 'error' THEN ts END AS t FROM events)
    """,
    "run_window": """
        SELECT event_id, '2024-01-08' AS first_day, '2024-03-12' AS last_day FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-03-12'
    """,
    "run_week": """
        SELECT event_id, ts FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-21'
    """,
    "order_windows": f"""
        SELECT o_orderkey,
            {ISO(MONDAY("o_orderdate") + " - 28")} AS first_day,
            {ISO("CAST(o_orderdate AS DATE) + 34")} AS last_day,
            {ISO(MONDAY("o_orderdate"))} AS week_start
        FROM orders
    """,
    "catalog_refresh": f"SELECT {REPORT}, {PARTITION} FROM events",
    "catalog_discovered": f"""
        SELECT {REPORT}, CASE WHEN hour(ts) >= 12 THEN 'pm' END AS delivery, {PARTITION} FROM events
    """,
    "mart_by_type_day": mart(
        "'set-' || event_type AS adset_id, upper(event_type) AS adset_name", "events", "event_type"
    ),
    "marts_refreshed": mart(
        "'set-' || event_type AS adset_id, upper(event_type) AS adset_name", f"({newest("'all'")})", "event_type"
    ),
    "monitoring_refreshed": monitoring("events", f"({newest("'all'")})"),
    "region_mart": mart("breakdown AS region", f"({newest('r_name')})", "breakdown"),
    "monitoring_by_account_day": monitoring("events", "events"),
    "report_family": " UNION ALL ".join(
        monitoring(report, f"({newest(breakdown)})") for report, breakdown in BREAKDOWNS.items()
    ),
    "family_with_gap": " UNION ALL ".join(
        monitoring(report, f"({newest(breakdown)})") for report, breakdown in BREAKDOWNS.items() if report != "region"
    ),
    "family_marts": " UNION ALL ".join(
        f"""SELECT '{report}' AS report, * FROM ({mart(f'{group} AS "group"', f"({newest(BREAKDOWNS[report])})", group)})"""
        for report, group in (
            ("age_gender", "breakdown"),
            ("region", "breakdown"),
            ("adset", "'set-' || event_type"),
        )
    ),
}
