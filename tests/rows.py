"""Small hand-made report rows."""

from __future__ import annotations

from reportmill.spec import ReportSpec

SPEC = ReportSpec("golden")


def raw_rows(spark, rows: list[dict]):
    """Raw report rows: unset key columns are equal, other unset columns are null."""
    defaults = {name: None for name in SPEC.columns}
    defaults.update({name: "x" for name in SPEC.key}, date_start="2024-01-02", account_id="A")
    schema = ", ".join(f"`{name}` string" for name in SPEC.columns)
    return spark.createDataFrame(
        [tuple({**defaults, **row}[name] for name in SPEC.columns) for row in rows], schema
    )


STORED = [
    {"account_id": "A", "ad_id": "1", "execution_date": "2024-01-03 00:00:00", "spend": "1"},
    {"account_id": "A", "ad_id": "2", "execution_date": "2024-01-03 00:00:00", "spend": "2"},
    {"account_id": "B", "ad_id": "1", "execution_date": "2024-01-03 00:00:00", "spend": "3"},
]
INCOMING = [
    {"ad_id": "1", "execution_date": "2024-01-04T00:00:00", "spend": "9.5"},
    {"ad_id": "2", "execution_date": "2024-01-01", "spend": "7"},
    {"ad_id": "3", "execution_date": "2024-01-04", "spend": "abc"},
    {"ad_id": "4", "date_start": "not-a-date", "execution_date": "2024-01-04", "spend": "1"},
    {"ad_id": "5", "account_id": None, "execution_date": "2024-01-04", "spend": "1"},
]
EXPECTED = [
    ("A", "1", "2024-01-04 00:00:00", "9.50000"),
    ("A", "2", "2024-01-03 00:00:00", "2.00000"),
    ("A", "3", "2024-01-04 00:00:00", None),
    ("B", "1", "2024-01-03 00:00:00", "3.00000"),
]


def short(df) -> list[tuple]:
    rows = df.selectExpr(
        "account_id", "ad_id", "cast(execution_date as string) v", "cast(spend as string) s"
    ).collect()
    return sorted(tuple(row) for row in rows)
