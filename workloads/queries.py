"""The registered queries. Each reads its whole tables and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.functions import (
    as_date,
    base_name,
    column,
    iso_day,
    landing_name,
    month_window,
    week_start,
)
from reportmill.operators.dedup import keep_latest
from reportmill.operators.filters import drop_dirty, in_month_window, in_week
from reportmill.operators.marts import build_mart, build_monitoring
from reportmill.operators.media import daily_spend, outer_join_on
from reportmill.operators.merge import list_partitions, touched_partitions, union_by_name
from reportmill.operators.nested import flatten_array, flatten_map
from reportmill.operators.shape import (
    cast_all,
    conform,
    map_columns,
    project,
    rename_all,
    with_constants,
    with_copies,
    with_partitions,
)
from reportmill.operators.versioned import upsert_versioned
from reportmill.plans.curate import curate_report
from reportmill.plans.family import ReportRun, run_family
from reportmill.plans.refresh import refresh_mart, refresh_monitoring
from reportmill.plans.spend import spend_summary
from reportmill.plans.warehouse import load_report, load_report_once
from reportmill.session import work_dir
from reportmill.sinks.catalog import publish, register_table
from reportmill.sinks.discovery import discover
from reportmill.sinks.export import CSV_OPTIONS, export_sorted, land_by_day
from reportmill.sinks.partitioned import write_partitions
from reportmill.sinks.warehouse import LOAD, append_table
from reportmill.sources import (
    parse_payloads,
    scan_curated,
    scan_delimited,
    scan_delimited_groups,
    scan_partitions,
    scan_payloads,
)
from reportmill.sources.headers import scan_by_header
from reportmill.spec import AFFILIATE_MAPPING, PARTITIONS, REPORTS, ReportSpec
from reportmill.streaming.incremental import curate_new_files, load_new_files
from workloads import inputs
from workloads.inputs import CUSTOM, HIGH_SPEND, MEDIA, MONEY, PURCHASE, table

EVENTS = ReportSpec("events")
TOTAL = "decimal(28,5)"
GAP = "region"


def suffix(path: str) -> str:
    return path.rsplit("-", 1)[-1][:12]


def plain_metrics(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({PURCHASE: "purchases", CUSTOM: "custom_value"})


def curated_rows(spark: SparkSession, target: str) -> DataFrame:
    return plain_metrics(scan_curated(spark, EVENTS, target))


def deliveries(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """All events as two CSV deliveries, one per half of the day; keys occur in both."""
    events = table(spark, sf_dir, "events")
    halves = {"am": inputs.is_morning(), "pm": ~inputs.is_morning()}
    return {
        name: inputs.land_csv(inputs.raw_report(events.where(half)), f"{root}/raw/{name}")
        for name, half in halves.items()
    }


def curate_events(spark: SparkSession, sf_dir: str, order: tuple[str, ...] = ("am", "pm")) -> DataFrame:
    root = work_dir(spark)
    landed = deliveries(spark, sf_dir, root)
    for name in order:
        curate_report(spark, EVENTS, landed[name], f"{root}/curated")
    return curated_rows(spark, f"{root}/curated")


def curation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and written per delivery: clean rows of its files, rows of the partitions it wrote."""
    root = work_dir(spark)
    landed = deliveries(spark, sf_dir, root)
    counts = []
    for name, path in landed.items():
        result = curate_report(spark, EVENTS, path, f"{root}/curated")
        clean = drop_dirty(conform(scan_delimited(spark, path), EVENTS), EVENTS)
        written = scan_partitions(spark, EVENTS, f"{root}/curated", result.partitions)
        counts.append((name, clean.count(), written.count()))
    return spark.createDataFrame(counts, "delivery string, rows_read long, rows_written long")


def upsert_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate_events(spark, sf_dir, ("pm", "am"))


def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate_events(spark, sf_dir, ("am", "pm", "am", "pm"))


def catalog_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into a catalog table, read from the table; the second one adds partitions."""
    root = work_dir(spark)
    events = table(spark, sf_dir, "events")
    early = F.dayofmonth("ts") <= 15
    loads = {"one": events.where(early & inputs.is_morning()), "two": events.where(~early | ~inputs.is_morning())}
    name = f"curated_events_{suffix(root)}"
    for load, rows in loads.items():
        path = inputs.land_csv(inputs.raw_report(rows), f"{root}/raw/{load}")
        curate_report(spark, EVENTS, path, f"{root}/curated", name)
    return plain_metrics(spark.table(name))


def load_days(events: DataFrame) -> dict[str, DataFrame]:
    """Events as three loads: the first half of each month, some later rows of few days, and the rest."""
    early, few = F.dayofmonth("ts") <= 15, F.dayofmonth("ts").isin(3, 4) & ~inputs.is_morning()
    return {"first": events.where(early & ~few), "few": events.where(few), "rest": events.where(~early)}


def versioned_events(
    spark: SparkSession, sf_dir: str, after: Callable[[str, str], None] | None = None, buckets: int | None = None
) -> tuple[str, str]:
    """All events through a versioned table, in three loads; ``after`` is called with table and root after each."""
    root = work_dir(spark)
    name, target = f"versioned_events_{suffix(root)}", f"{root}/curated"
    for load, rows in load_days(table(spark, sf_dir, "events")).items():
        path = inputs.land_csv(inputs.raw_report(rows), f"{root}/raw/{load}")
        upsert_versioned(drop_dirty(conform(scan_delimited(spark, path), EVENTS), EVENTS), EVENTS, name, target, buckets)
        if after:
            after(name, target)
    return name, root


def curate_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, _ = versioned_events(spark, sf_dir)
    return plain_metrics(spark.table(name))


def curate_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same loads into a table in four buckets, whose stored rows are not shuffled again."""
    name, _ = versioned_events(spark, sf_dir, buckets=4)
    return plain_metrics(spark.table(name))


def marts_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after three loads, the second of few days, each followed by a refresh of its days."""
    published: list[str] = []

    def refresh(name: str, target: str) -> None:
        root, tag = target.rsplit("/", 1)[0], suffix(target.rsplit("/", 1)[0])
        published[:] = refresh_mart(name, target, EVENTS, "events_mart", f"{root}/marts", (f"dev_{tag}", f"prd_{tag}"))

    versioned_events(spark, sf_dir, refresh)
    return plain_metrics(spark.table(published[-1])).select(
        "adset_id", "adset_name", "date_start", "clicks", "impressions", "purchases", "custom_value", "spend"
    )


def monitoring_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    published: list[str] = []

    def refresh(name: str, target: str) -> None:
        root, tag = target.rsplit("/", 1)[0], suffix(target.rsplit("/", 1)[0])
        published[:] = refresh_monitoring(name, target, EVENTS, "events_watch", f"{root}/marts", (f"dev_{tag}",))

    versioned_events(spark, sf_dir, refresh)
    return monitoring_columns(spark.table(published[0]))


def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark)
    events = table(spark, sf_dir, "events")
    for name, half in {"am": inputs.is_morning(), "pm": ~inputs.is_morning()}.items():
        inputs.land_csv(inputs.raw_report(events.where(half)), f"{root}/raw/{name}")
        curate_new_files(
            spark, EVENTS, f"{root}/raw", f"{root}/curated", f"{root}/checkpoint"
        )
    return curated_rows(spark, f"{root}/curated")


def scan_recursive_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark)
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    inputs.land_csv(events.where(inputs.is_morning()), f"{root}/raw/2024/early")
    inputs.land_csv(events.where(~inputs.is_morning()), f"{root}/raw/2024/late/parts")
    types = {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "value": "double"}
    return cast_all(scan_delimited(spark, f"{root}/raw"), types)


def quoted_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with commas, quotes, backslashes and blanks at the ends; line breaks become blanks."""
    texts = [
        table(spark, sf_dir, name).select(F.lit(name).alias("source"), F.col(key).cast("string").alias("id"), "text")
        for name, key in (("documents", "doc_id"), ("conversations", "conv_id"))
    ]
    flat = F.regexp_replace("text", "[\\r\\n]", " ")
    quoted = F.concat(F.lit(' "'), F.replace(F.replace(flat, F.lit("e "), F.lit('e", ')), F.lit("n "), F.lit("n\\ ")), F.lit('\\" '))
    return texts[0].unionByName(texts[1]).select("source", "id", quoted.alias("text"), F.lit(9).alias("after"))


def scan_quoted_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.land_csv(quoted_texts(spark, sf_dir), f"{work_dir(spark)}/quoted")
    return cast_all(scan_delimited(spark, path, maxCharsPerColumn=-1), {"after": "int"})


def scan_multiline_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same texts with their line breaks."""
    texts = [
        table(spark, sf_dir, name).select(F.lit(name).alias("source"), F.col(key).cast("string").alias("id"), "text")
        for name, key in (("documents", "doc_id"), ("conversations", "conv_id"))
    ]
    rows = texts[0].unionByName(texts[1]).withColumn("after", F.lit(9))
    path = inputs.land_csv(rows, f"{work_dir(spark)}/lines")
    return cast_all(scan_delimited(spark, path, multiLine=True, maxCharsPerColumn=-1), {"after": "int"})


def scan_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with permuted and missing columns side by side in one folder."""
    root = work_dir(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    status = F.coalesce("o_orderstatus", F.lit(""))
    shapes = {"F": orders.columns, "O": orders.columns[::-1], "": ["o_orderstatus", "o_orderkey", "o_custkey"]}
    for value, names in shapes.items():
        rows = orders.where(status == value if value else ~status.isin(*filter(None, shapes)))
        rows.select(*names).write.mode("append").options(**CSV_OPTIONS).csv(f"{root}/raw")
    return cast_all(scan_by_header(spark, f"{root}/raw"), {"o_orderkey": "bigint", "o_custkey": "bigint"})


def scan_header_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    closed = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    inputs.land_csv(orders.where(closed), f"{root}/a")
    inputs.land_csv(
        orders.where(~closed).select("o_orderstatus", "o_orderkey", "o_custkey"), f"{root}/b"
    )
    rows = scan_delimited_groups(spark, [f"{root}/a", f"{root}/b"])
    return cast_all(rows, {"o_orderkey": "bigint", "o_custkey": "bigint"})


def keep_latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, prefer = ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]
    return keep_latest(table(spark, sf_dir, "lineitem"), key, "l_shipdate", prefer)


def latest_document_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(table(spark, sf_dir, "documents"), ["text"], "doc_id")


def union_by_name_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    closed = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    permuted = orders.where(~closed).select(*reversed(orders.columns))
    return union_by_name(orders.where(closed), permuted, orders.columns)


def stored_events(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Every event in the curated layout, without removing older versions."""
    target = f"{work_dir(spark)}/curated"
    typed_rows = conform(inputs.raw_report(table(spark, sf_dir, "events")), EVENTS)
    write_partitions(with_partitions(typed_rows, EVENTS), target, PARTITIONS)
    return target, scan_curated(spark, EVENTS, target)


def touched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _ = stored_events(spark, sf_dir)
    large = table(spark, sf_dir, "events").where(F.col("value") >= HIGH_SPEND)
    touched = touched_partitions(conform(inputs.raw_report(large), EVENTS), EVENTS)
    return plain_metrics(scan_partitions(spark, EVENTS, target, list_partitions(touched)))


def partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform(inputs.raw_report(table(spark, sf_dir, "events")), EVENTS)
    return touched_partitions(rows, EVENTS)


def dirty_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    raw = inputs.raw_report(events, F.hour("ts").alias("hour"))
    broken = raw.withColumns(
        {
            "account_id": F.nullif(F.col("account_id"), F.lit("error")),
            "date_start": F.when(F.col("hour") == 13, "not-a-date").otherwise(F.col("date_start")),
        }
    )
    return plain_metrics(drop_dirty(conform(broken, EVENTS), EVENTS))


def typed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counter = inputs.counter(F.col("props"))
    number = counter.cast("int")
    hour = F.hour("ts")
    texts = table(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.when(number >= 90, "n/a")
        .when(number >= 80, F.concat(counter, F.lit(".7")))
        .when(number >= 70, F.concat(counter, F.lit("000000000")))
        .otherwise(counter)
        .alias("clicks"),
        F.when(hour == 0, "abc")
        .when(hour == 1, "12345678901234567890")
        .otherwise(F.col("value").cast("string"))
        .alias("spend"),
        F.when(hour == 2, "2024-13-45").otherwise(F.col("ts").cast("string")).alias("execution_date"),
    )
    typed = cast_all(texts, {"clicks": "int", "spend": MONEY, "execution_date": "timestamp"})
    # Some comparisons read a nullable integer as a float, so nulls are told in a column of their own.
    return typed.withColumns({"clicks_missing": F.isnull("clicks"), "clicks": F.coalesce("clicks", F.lit(-1))})


def cast_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles that print with exponents, as integers: the fraction is cut."""
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    numbers = joined.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("o_totalprice").cast("double") * 1000).alias("large"),
        (F.col("l_discount").cast("double") / 1000).alias("small"),
    )
    return cast_all(numbers, {"large": "int", "small": "int"})


def mapping_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = [
        ("l_orderkey", "order_key", "string"),
        ("l_linenumber", "line_number", "int"),
        ("l_quantity", "quantity", "int"),
        ("l_extendedprice", "price", MONEY),
        ("l_discount", "discount", MONEY),
        ("l_returnflag", "return_flag", "string"),
        ("l_linestatus", "line_status", "string"),
        ("l_shipdate", "shipped", "timestamp"),
    ]
    lineitem = table(spark, sf_dir, "lineitem")
    texts = lineitem.select(*[F.col(name).cast("string").alias(name) for name in lineitem.columns])
    return map_columns(texts, mapping)


def rename_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"o_orderkey": "key", "key": "order_key", "no_such": "x", "o_orderstatus": "status"}
    return rename_all(table(spark, sf_dir, "orders"), names)


def constants_and_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = with_constants(table(spark, sf_dir, "events"), platform="web", type="events")
    copied = with_copies(tagged, account="event_type")
    return project(copied, ["account", "platform", "type", "event_id", "user_id"])


def dotted_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark)}/dotted"
    rows = conform(inputs.raw_report(table(spark, sf_dir, "events")), EVENTS)
    rows.write.parquet(path)
    picked = project(
        spark.read.parquet(path), ["campaign_name", f"`{PURCHASE}`", f"`{CUSTOM}`", "`spend`"]
    )
    return plain_metrics(picked)


def warehouse_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark)
    landed = inputs.land_csv(
        inputs.affiliate_report(table(spark, sf_dir, "orders")), f"{root}/raw"
    )
    name = f"affiliate_{suffix(root)}"
    for _ in range(2):
        load_report(
            spark,
            AFFILIATE_MAPPING,
            landed,
            lambda rows: append_table(rows, name, f"{root}/warehouse"),
        )
    return spark.table(name)


def affiliate_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    closed = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    return {"closed": inputs.affiliate_report(orders.where(closed)), "open": inputs.affiliate_report(orders.where(~closed))}


def warehouse_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into a warehouse table, each run twice."""
    root = work_dir(spark)
    name = f"affiliate_{suffix(root)}"
    for part, rows in affiliate_parts(spark, sf_dir).items():
        landed = inputs.land_csv(rows, f"{root}/raw/{part}")
        for _ in range(2):
            load_report_once(spark, AFFILIATE_MAPPING, landed, name, f"{root}/warehouse")
    return spark.table(name).drop(LOAD)


def warehouse_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A growing folder loaded as it grows; the last run finds nothing new."""
    root = work_dir(spark)
    name = f"affiliate_{suffix(root)}"
    for part, rows in {**affiliate_parts(spark, sf_dir), "none": None}.items():
        if rows is not None:
            inputs.land_csv(rows, f"{root}/raw/{part}")
        load_new_files(spark, AFFILIATE_MAPPING, f"{root}/raw", name, f"{root}/warehouse", f"{root}/checkpoint")
    return spark.table(name).drop(LOAD)


def daily_media_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_spend(
        table(spark, sf_dir, "events"), F.to_date("ts"), "event_type", F.col("value").cast(MONEY)
    )
    return daily.withColumn("day", iso_day(F.col("day")))


def media_schema() -> str:
    return ", ".join(f"`{name}` map<string, struct<spend: {TOTAL}>>" for name in MEDIA)


def map_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.media_documents(inputs.daily_events(table(spark, sf_dir, "events")))
    parsed = parse_payloads(documents, media_schema())
    flat = [
        with_constants(flatten_map(parsed, name, "spend", "day", "spend"), medium=name)
        for name in MEDIA
    ]
    return reduce(DataFrame.unionByName, flat)


def array_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.linear_documents(table(spark, sf_dir, "events"))
    schema = f"weekSummary array<struct<day: string, electronic: {TOTAL}>>"
    parsed = parse_payloads(documents, schema, ["weekSummary"])
    return flatten_array(parsed, "weekSummary", {"day": "day", "electronic": "spend"})


def props_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "map<string, int>")
    return table(spark, sf_dir, "events").select("event_id", F.explode(props).alias("name", "number"))


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.media_documents(inputs.daily_user_events(table(spark, sf_dir, "events")))
    found = F.size(F.json_object_keys("value"))
    return documents.select(
        "document", found.alias("keys_found"), (found == len(MEDIA)).alias("complete")
    )


def media_outer_join(spark: SparkSession, sf_dir: str, hot_keys: bool = False) -> DataFrame:
    daily = inputs.daily_trade(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    sides = {"streaming": "video", "audio": "audio"}
    video, audio = (
        daily.where(F.col("medium") == medium).select("day", F.col("spend").alias(label))
        for medium, label in sides.items()
    )
    return outer_join_on(video, audio, "day", hot_keys)


def media_outer_join_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_outer_join(spark, sf_dir, hot_keys=True)


def spend_summary_csv(spark: SparkSession, sf_dir: str, rounds: tuple[int, ...] = (1,)) -> DataFrame:
    """The summary over landed documents; each round delivers all of them with its factor on the spend."""
    root = work_dir(spark)
    daily = inputs.daily_trade(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    events = table(spark, sf_dir, "events")
    streaming, linear = f"{root}/streaming", f"{root}/linear"
    for number, factor in enumerate(rounds):
        scaled = daily.withColumn("spend", (F.col("spend") * factor).cast(TOTAL))
        inputs.land_documents(inputs.streaming_documents(scaled), f"{streaming}/{number}")
        inputs.land_documents(
            inputs.linear_documents(events.withColumn("value", F.col("value") * factor)), f"{linear}/{number}"
        )
    days = f"map<string, struct<spend: {TOTAL}>>"
    landed = spend_summary(
        spark,
        streaming,
        linear,
        f"{root}/landing",
        "media",
        dt.date(2024, 2, 7),
        streaming_schema=f"audio {days}, streaming {days}",
        linear_schema=f"weekSummary array<struct<day: string, electronic: {TOTAL}>>",
    )
    summary = scan_delimited(spark, landed)
    return summary.select(
        F.col("Date").alias("day"),
        F.col("Streaming Video").try_cast(TOTAL).alias("video"),
        F.col("Streaming Audio").try_cast(TOTAL).alias("audio"),
        F.col("Linear TV").try_cast(TOTAL).alias("linear"),
    )


def spend_summary_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spend_summary_csv(spark, sf_dir, rounds=(3, 1))


def sorted_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark)}/export"
    totals = table(spark, sf_dir, "orders").groupBy(iso_day(F.col("o_orderdate")).alias("Date")).agg(
        F.sum(F.col("o_totalprice").cast(MONEY)).cast(TOTAL).alias("total")
    )
    export_sorted(totals, path, "Date")
    return scan_delimited(spark, path).select(
        F.col("Date").alias("day"), F.col("total").try_cast(TOTAL).alias("total")
    )


def landing_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = landing_name("media", "spend_summary", F.col("o_orderdate"))
    days = table(spark, sf_dir, "orders").select("o_orderdate").distinct()
    return days.select(name.alias("object_name")).withColumn("file_name", base_name(F.col("object_name")))


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark)}/landing"
    land_by_day(table(spark, sf_dir, "events").select("event_id", "event_type", "ts"), path, "ts")
    stored = "event_id bigint, event_type string, ts timestamp, year string, month string, day string"
    return spark.read.schema(stored).option("header", True).csv(path)


def landing_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a day are landed too, and read back."""
    path = f"{work_dir(spark)}/landing"
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    land_by_day(events.withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts"))), path, "ts")
    stored = "event_id bigint, event_type string, ts timestamp, year string, month string, day string"
    return spark.read.schema(stored).option("header", True).csv(path)


def run_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = month_window("2024-02-07")
    return in_month_window(table(spark, sf_dir, "events"), "ts", "2024-02-07").select(
        "event_id", iso_day(first).alias("first_day"), iso_day(last).alias("last_day")
    )


def run_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_week(table(spark, sf_dir, "events"), "ts", "2024-01-18").select("event_id", "ts")


def order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = as_date(F.col("o_orderdate"))
    first, last = month_window(day)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        iso_day(first).alias("first_day"),
        iso_day(last).alias("last_day"),
        iso_day(week_start(day)).alias("week_start"),
    )


def catalog_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _ = stored_events(spark, sf_dir)
    name = f"events_{suffix(target.rsplit('/', 1)[0])}"
    register_table(spark, name, target, EVENTS.curated_schema, PARTITIONS)
    return plain_metrics(spark.table(name))


def catalog_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered table after another writer added the evening's rows, with a column of their own."""
    root = work_dir(spark)
    target, name = f"{root}/curated", f"events_{suffix(root)}"
    events = table(spark, sf_dir, "events")

    def typed(rows: DataFrame) -> DataFrame:
        return with_partitions(conform(inputs.raw_report(rows), EVENTS), EVENTS)

    write_partitions(typed(events.where(inputs.is_morning())), target, PARTITIONS)
    register_table(spark, name, target, EVENTS.curated_schema, PARTITIONS)
    foreign = typed(events.where(~inputs.is_morning())).withColumn("delivery", F.lit("pm"))
    foreign.repartition(*PARTITIONS).write.mode("append").partitionBy(*PARTITIONS).parquet(target)
    discover(spark, name, target, PARTITIONS)
    return plain_metrics(spark.table(name))


def mart_by_type_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform(inputs.raw_report(table(spark, sf_dir, "events")), EVENTS)
    root = work_dir(spark)
    mart = build_mart(rows, EVENTS).withColumns(
        {name: F.col(name).cast(TOTAL) for name in ("spend", "impressions")}
    )
    tables = publish(plain_metrics(mart), f"events_mart_{suffix(root)}", f"{root}/marts")
    return spark.table(tables[-1]).select(
        "adset_id", "adset_name", "date_start", "clicks", "impressions", "purchases", "custom_value", "spend"
    )


def monitoring_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "report",
        "account",
        iso_day(F.col("day")).alias("day"),
        "row_count",
        "last_date_start",
        "last_execution_date",
        "spend",
        "null_clicks",
        column(f"null_{PURCHASE.replace('.', '_')}").alias("null_purchases"),
    )


def monitoring_by_account_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform(inputs.raw_report(table(spark, sf_dir, "events")), EVENTS)
    return monitoring_columns(build_monitoring(with_partitions(rows, EVENTS), EVENTS))


def family_runs(
    spark: SparkSession, sf_dir: str, specs: tuple[ReportSpec, ...], without_files: tuple[str, ...] = ()
) -> list[ReportRun]:
    root = work_dir(spark)
    landed = inputs.land_csv(inputs.raw_family(spark, sf_dir), f"{root}/raw", **inputs.COMPRESSED)
    tag = suffix(root)
    return run_family(
        spark,
        "ads",
        root,
        f"{root}/curated",
        f"{root}/marts",
        specs,
        source_of=lambda spec: f"{root}/empty" if spec.report_type in without_files else landed,
        curated_db=f"curated_{tag}",
        environments=(f"dev_{tag}", f"prd_{tag}"),
    )


def report_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = family_runs(spark, sf_dir, REPORTS)
    return reduce(
        DataFrame.unionByName, [monitoring_columns(spark.table(run.monitoring)) for run in runs]
    )


def family_with_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report has no files today; the others come out in full."""
    runs = family_runs(spark, sf_dir, REPORTS, without_files=(GAP,))
    return reduce(
        DataFrame.unionByName,
        [monitoring_columns(spark.table(run.monitoring)) for run in runs if run.monitoring],
    )


def family_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three marts as published to the last environment."""
    marts = {
        run.report_type: plain_metrics(spark.table(run.marts[-1]))
        for run in family_runs(spark, sf_dir, tuple(spec for spec in REPORTS if spec.mart))
    }
    groups = {"age_gender": "age", "region": "region", "adset": "adset_id"}
    return reduce(
        DataFrame.unionByName,
        [
            marts[report].select(
                F.lit(report).alias("report"),
                F.col(group).alias("group"),
                "date_start",
                "clicks",
                "impressions",
                "purchases",
                "custom_value",
                "spend",
            )
            for report, group in groups.items()
        ],
    )


def region_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReportSpec("region", breakdowns=("region",))
    rows = keep_latest(
        conform(inputs.raw_family(spark, sf_dir), spec), spec.key, spec.version
    )
    return plain_metrics(build_mart(rows, spec))


QUERIES = {
    "curate_events": curate_events,
    "curation_counts": curation_counts,
    "upsert_out_of_order": upsert_out_of_order,
    "upsert_idempotent": upsert_idempotent,
    "catalog_upsert": catalog_upsert,
    "curate_versioned": curate_versioned,
    "curate_bucketed": curate_bucketed,
    "incremental_files": incremental_files,
    "scan_recursive_csv": scan_recursive_csv,
    "scan_header_groups": scan_header_groups,
    "scan_mixed_headers": scan_mixed_headers,
    "scan_quoted_csv": scan_quoted_csv,
    "scan_multiline_csv": scan_multiline_csv,
    "keep_latest_lineitem": keep_latest_lineitem,
    "latest_document_by_text": latest_document_by_text,
    "union_by_name_orders": union_by_name_orders,
    "touched_partitions": touched_rows,
    "partition_keys": partition_keys,
    "dirty_filter": dirty_filter,
    "typed_metrics": typed_metrics,
    "cast_doubles": cast_doubles,
    "mapping_lineitem": mapping_lineitem,
    "rename_orders": rename_orders,
    "constants_and_copies": constants_and_copies,
    "dotted_columns": dotted_columns,
    "warehouse_append": warehouse_append,
    "warehouse_replayed": warehouse_replayed,
    "warehouse_new_files": warehouse_new_files,
    "daily_media_spend": daily_media_spend,
    "map_flatten": map_flatten,
    "array_flatten": array_flatten,
    "props_flatten": props_flatten,
    "completeness": completeness,
    "media_outer_join": media_outer_join,
    "media_outer_join_hot": media_outer_join_hot,
    "spend_summary": spend_summary_csv,
    "spend_summary_redelivered": spend_summary_redelivered,
    "sorted_export": sorted_export,
    "landing_layout": landing_layout,
    "landing_roundtrip": landing_roundtrip,
    "landing_undated": landing_undated,
    "run_window": run_window,
    "run_week": run_week,
    "order_windows": order_windows,
    "catalog_refresh": catalog_refresh,
    "catalog_discovered": catalog_discovered,
    "mart_by_type_day": mart_by_type_day,
    "region_mart": region_mart,
    "marts_refreshed": marts_refreshed,
    "monitoring_by_account_day": monitoring_by_account_day,
    "monitoring_refreshed": monitoring_refreshed,
    "report_family": report_family,
    "family_with_gap": family_with_gap,
    "family_marts": family_marts,
}
