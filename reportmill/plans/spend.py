"""Daily spend summary over streaming and linear media payloads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportmill.operators.dedup import keep_latest
from reportmill.operators.media import combine_media
from reportmill.operators.nested import flatten_array, flatten_map
from reportmill.sinks.export import land_report
from reportmill.sources import parse_payloads, scan_payloads
from reportmill.sources.payloads import DELIVERED, ORIGIN
from reportmill.spec import (
    AUDIO_LABEL,
    DATE_LABEL,
    LINEAR_LABEL,
    LINEAR_PAYLOAD,
    STREAMING_PAYLOAD,
    VIDEO_LABEL,
)

PLACE = "__place"


def summarize_spend(
    streaming: DataFrame,
    linear: DataFrame,
    streaming_schema: str = STREAMING_PAYLOAD,
    linear_schema: str = LINEAR_PAYLOAD,
) -> DataFrame:
    """One row per date with the spend of each medium; a missing medium is null.

    Deliveries may overlap: per medium and date the newest delivery counts, and within one
    document the last entry, so the joins are one to one. Documents without exactly the expected
    top-level keys fail the run.
    """
    media = parse_payloads(dated(streaming), streaming_schema, ["audio", "streaming"])
    weeks = parse_payloads(dated(linear), linear_schema, ["weekSummary"])
    carry = [DELIVERED, ORIGIN]
    array = flatten_array(weeks, "weekSummary", {"day": DATE_LABEL, "electronic": LINEAR_LABEL}, carry, PLACE)
    return combine_media(
        [
            newest(flatten_map(media, "streaming", "spend", DATE_LABEL, VIDEO_LABEL, carry)),
            newest(flatten_map(media, "audio", "spend", DATE_LABEL, AUDIO_LABEL, carry)),
            newest(array),
        ],
        DATE_LABEL,
    )


def dated(documents: DataFrame) -> DataFrame:
    """Documents with delivery columns; without any, all count as one delivery."""
    missing = {DELIVERED: F.lit(None).cast("timestamp"), ORIGIN: F.lit("")}
    return documents.withColumns({n: v for n, v in missing.items() if n not in documents.columns})


def newest(rows: DataFrame) -> DataFrame:
    prefer = [name for name in (ORIGIN, PLACE) if name in rows.columns]
    return keep_latest(rows, [DATE_LABEL], DELIVERED, prefer).drop(DELIVERED, ORIGIN, PLACE)


def spend_summary(
    spark: SparkSession,
    streaming_path: str,
    linear_path: str,
    root: str,
    source: str,
    day: dt.date | None = None,
    **schemas: str,
) -> str:
    """Summarize landed payloads and land the sorted CSV under the run day."""
    streaming, linear = scan_payloads(spark, streaming_path), scan_payloads(spark, linear_path)
    if streaming.isEmpty() or linear.isEmpty():
        raise ValueError("incomplete payloads: a medium has no documents")
    summary = summarize_spend(streaming, linear, **schemas)
    run_day = day or dt.date.today()
    return land_report(summary, root, source, "spend_summary", run_day, DATE_LABEL)
