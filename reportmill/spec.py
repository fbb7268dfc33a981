"""What a report looks like: key, version, metrics, and the fixed lists behind it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import types as T

# Names and types of the ad report columns.
DIMENSIONS = (
    "account_id",
    "ad_creative_instagram_permalink_url",
    "ad_id",
    "ad_name",
    "adset_id",
    "adset_name",
    "campaign_id",
    "date_start",
)
VERSION = "execution_date"
METRICS = MappingProxyType(
    {
        "clicks": "integer",
        "impressions": "decimal(18,5)",
        "actions.offsite_conversion.fb_pixel_purchase": "decimal(18,5)",
        "action_values.offsite_conversion.fb_pixel_custom": "decimal(18,5)",
        "spend": "decimal(18,5)",
    }
)
ADDITIONAL = ("attribution_model", "account_name", "account_currency", "campaign_name")
PARTITIONS = ("account", "year", "month", "day")

# The report family and, for each report, its breakdown columns.
REPORT_BREAKDOWNS = MappingProxyType(
    {
        "country": ("country",),
        "adset": (),
        "age_gender": ("age", "gender"),
        "device_platform": ("device_platform",),
        "dma": ("dma",),
        "hourly_advertiser_tz": ("hourly_stats_aggregated_by_advertiser_time_zone",),
        "publisher_platform": ("publisher_platform",),
        "region": ("region",),
    }
)
MART_REPORTS = ("age_gender", "region", "adset")

# Affiliate report mapping as (source column, target column, type).
AFFILIATE_MAPPING = (
    ("Date", "date", "string"),
    ("Brand", "brand", "string"),
    ("Publisher", "publisher", "string"),
    ("Channel", "publisher_type", "string"),
    ("Clicks", "clicks", "int"),
    ("Revenue - Gross", "revenue_gross", "decimal(18,5)"),
    ("Orders - Gross", "orders_gross", "int"),
    ("Total Commission - Gross", "commission_gross", "decimal(18,5)"),
    ("Total Commission - Net", "commission_net", "decimal(18,5)"),
    ("Total Spend - Net", "spend_net", "decimal(18,5)"),
    ("Total Spend - Gross", "spend_gross", "decimal(18,5)"),
    ("Execution_date", "execution_date", "string"),
)

# Media payload shapes and the labels of the spend summary.
STREAMING_PAYLOAD = (
    "audio map<string, struct<spend: double>>, streaming map<string, struct<spend: double>>"
)
LINEAR_PAYLOAD = "weekSummary array<struct<day: string, electronic: double>>"
DATE_LABEL = "Date"
VIDEO_LABEL = "Streaming Video"
AUDIO_LABEL = "Streaming Audio"
LINEAR_LABEL = "Linear TV"


@dataclass(frozen=True)
class ReportSpec:
    """One report: rows sharing a key are versions of one fact, the newest version wins.

    The account and date columns belong to the key and also decide the partition, so every
    version of a key lives in a single partition of the curated table.
    """

    report_type: str
    dimensions: tuple[str, ...] = DIMENSIONS
    breakdowns: tuple[str, ...] = ()
    metrics: Mapping[str, str] = field(default_factory=lambda: METRICS)
    additional: tuple[str, ...] = ADDITIONAL
    account: str = "account_id"
    date: str = "date_start"
    version: str = VERSION
    mart: bool = False
    # Quoted values of the files may hold line breaks. Such a file is read by a single task.
    multi_line: bool = False

    def __post_init__(self) -> None:
        missing = {self.account, self.date} - set(self.key)
        if missing:
            raise ValueError(f"partition sources must be part of the key: {sorted(missing)}")

    @property
    def key(self) -> tuple[str, ...]:
        return self.dimensions + self.breakdowns

    @property
    def columns(self) -> tuple[str, ...]:
        return self.key + (self.version,) + self.additional + tuple(self.metrics)

    @property
    def types(self) -> dict[str, str]:
        """Target type of every column that does not stay a string."""
        return {self.date: "timestamp", self.version: "timestamp", **self.metrics}

    @property
    def curated_schema(self) -> T.StructType:
        """Stored columns followed by the partition columns, which are directory strings."""
        schema = T.StructType()
        for name in self.columns:
            schema = schema.add(name, self.types.get(name, "string"))
        for name in PARTITIONS:
            schema = schema.add(name, "string")
        return schema


REPORTS = tuple(
    ReportSpec(name, breakdowns=breakdowns, mart=name in MART_REPORTS)
    for name, breakdowns in REPORT_BREAKDOWNS.items()
)
