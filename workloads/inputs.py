"""Report-shaped inputs that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.functions import iso_day
from reportmill.operators.media import daily_spend
from reportmill.sinks.bounded import shuffles_dropped
from reportmill.sinks.export import CSV_OPTIONS

PURCHASE = "actions.offsite_conversion.fb_pixel_purchase"
CUSTOM = "action_values.offsite_conversion.fb_pixel_custom"
MEDIA = ("click", "error", "purchase", "signup", "view")
MONEY = "decimal(18,5)"
HIGH_SPEND = 250
# A compressed file is read by a single task, so its rows are bounded.
COMPRESSED = {"compression": "snappy", "maxRecordsPerFile": 100_000}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counter(events_props: Column) -> Column:
    return F.get_json_object(events_props, "$.k")


def raw_report(events: DataFrame, *extra: Column) -> DataFrame:
    """Events as raw ad report rows, all strings: one key per event type, user and day."""
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    spend = F.col("value").cast("string")
    return events.select(
        kind.alias("account_id"),
        F.concat(F.lit("https://example.com/ad/"), user).alias(
            "ad_creative_instagram_permalink_url"
        ),
        user.alias("ad_id"),
        F.concat(F.lit("ad "), user).alias("ad_name"),
        F.concat(F.lit("set-"), kind).alias("adset_id"),
        F.upper(kind).alias("adset_name"),
        F.lit("all").alias("campaign_id"),
        iso_day(F.col("ts")).alias("date_start"),
        F.col("ts").cast("string").alias("execution_date"),
        counter(F.col("props")).alias("clicks"),
        F.col("event_id").cast("string").alias("impressions"),
        F.when(kind == "purchase", spend).alias(PURCHASE),
        F.when(kind != "purchase", spend).alias(CUSTOM),
        spend.alias("spend"),
        F.lit("7d_click").alias("attribution_model"),
        F.concat(kind, F.lit(" account")).alias("account_name"),
        F.lit("USD").alias("account_currency"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("campaign_name"),
        *extra,
    )


def breakdown_columns() -> list[Column]:
    """Breakdowns of the report family, read off the event, its user and the user's nation."""
    hour = F.lpad(F.hour("ts").cast("string"), 2, "0")
    amount = F.col("value")
    return [
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("dma"),
        F.floor(counter(F.col("props")).cast("int") / 10).cast("string").alias("age"),
        F.lit("unknown").alias("gender"),
        F.when(F.hour("ts") < 12, "desktop").otherwise("mobile").alias("device_platform"),
        F.when(amount < 10, "feed").when(amount < 50, "story").otherwise("search").alias(
            "publisher_platform"
        ),
        F.concat(hour, F.lit(":00:00 - "), hour, F.lit(":59:59")).alias(
            "hourly_stats_aggregated_by_advertiser_time_zone"
        ),
    ]


def raw_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of all eight reports: every event with all breakdown columns.

    Spark broadcasts what it measures as small.
    """
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    events = (
        table(spark, sf_dir, "events")
        .join(customers, F.col("user_id") == F.col("c_custkey"), "left")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    return raw_report(events, *breakdown_columns())


def land_csv(df: DataFrame, path: str, **options: object) -> str:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").options(**{**CSV_OPTIONS, **options}).csv(path)
    return path


def is_morning() -> Column:
    return F.hour("ts") < 12


def daily_events(events: DataFrame) -> DataFrame:
    """Spend per day and event type, with days as text and the Monday of their week."""
    daily = daily_spend(events, F.to_date("ts"), "event_type", F.col("value").cast(MONEY))
    return daily.select(
        iso_day(F.date_trunc("week", F.col("day"))).alias("document"),
        iso_day(F.col("day")).alias("day"),
        "medium",
        "spend",
    )


def daily_user_events(events: DataFrame) -> DataFrame:
    """Spend per user, day and event type; a document is one day of one user."""
    day = iso_day(F.col("ts"))
    document = F.concat_ws("/", F.col("user_id").cast("string"), day)
    return events.groupBy(document.alias("document"), day.alias("day"), F.col("event_type").alias("medium")).agg(
        F.sum(F.col("value").cast(MONEY)).alias("spend")
    )


def daily_trade(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Ordered value per order day and shipped value per ship day; a document is one month."""
    parts = []
    for rows, day, amount, medium in (
        (orders, "o_orderdate", "o_totalprice", "streaming"),
        (lineitem, "l_shipdate", "l_extendedprice", "audio"),
    ):
        totals = rows.groupBy(F.to_date(day).alias("day")).agg(
            F.sum(F.col(amount).cast(MONEY)).alias("spend")
        )
        parts.append(
            totals.select(
                F.date_format("day", "yyyy-MM").alias("document"),
                iso_day(F.col("day")).alias("day"),
                F.lit(medium).alias("medium"),
                "spend",
            )
        )
    return parts[0].unionByName(parts[1])


def media_documents(daily: DataFrame) -> DataFrame:
    """JSON documents of medium, day and spend, with the media that occur in each.

    The rows are daily totals, so a list holds the days of one document and no more.
    """
    days = daily.groupBy("document", "medium").agg(
        F.map_from_entries(F.collect_list(day_entry())).alias("days")
    )
    return days.groupBy("document").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("medium", "days")))).alias("value")
    )


def streaming_documents(daily: DataFrame) -> DataFrame:
    """JSON documents with both media, either of which may be empty."""
    media = [
        F.map_from_entries(
            F.collect_list(F.when(F.col("medium") == medium, day_entry()))
        ).alias(medium)
        for medium in ("audio", "streaming")
    ]
    return daily.groupBy("document").agg(F.to_json(F.struct(*media)).alias("value"))


def day_entry() -> Column:
    return F.struct("day", F.struct("spend").alias("entry"))


def linear_documents(events: DataFrame) -> DataFrame:
    """One JSON document per week with an array of daily spend over all media."""
    days = (
        daily_events(events)
        .groupBy("document", "day")
        .agg(F.sum("spend").cast("decimal(28,5)").alias("electronic"))
        .groupBy("document")
        .agg(F.collect_list(F.struct("day", "electronic")).alias("weekSummary"))
    )
    return days.select("document", F.to_json(F.struct("weekSummary")).alias("value"))


def land_documents(documents: DataFrame, path: str) -> str:
    """One file per document."""
    documents.write.mode("overwrite").partitionBy("document").text(path)
    return path


def affiliate_report(orders: DataFrame) -> DataFrame:
    """Orders as raw affiliate report rows, with a net commission that is not always a number."""
    total = F.col("o_totalprice").cast("string")
    return orders.select(
        iso_day(F.col("o_orderdate")).alias("Date"),
        F.col("o_orderpriority").alias("Brand"),
        F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("Publisher"),
        F.col("o_orderstatus").alias("Channel"),
        F.col("o_custkey").cast("string").alias("Clicks"),
        total.alias("Revenue - Gross"),
        F.lit("1").alias("Orders - Gross"),
        total.alias("Total Commission - Gross"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(total).alias(
            "Total Commission - Net"
        ),
        total.alias("Total Spend - Net"),
        total.alias("Total Spend - Gross"),
        F.col("o_orderkey").cast("string").alias("Order"),
        F.col("o_orderdate").cast("string").alias("Execution_date"),
    )
