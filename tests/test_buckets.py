"""Versioned tables in buckets."""

from __future__ import annotations

import glob
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reportmill.operators import versioned
from reportmill.operators.filters import drop_dirty
from reportmill.operators.shape import conform, project, with_partitions
from reportmill.operators.versioned import upsert_versioned
from reportmill.session import work_dir
from reportmill.sinks import versions
from reportmill.sinks.versions import Buckets, replace_partitions, table_buckets
from reportmill.spec import PARTITIONS
from rows import EXPECTED, INCOMING, SPEC, STORED, raw_rows, short

BUCKETS = 4


def clean(spark, rows):
    return drop_dirty(conform(raw_rows(spark, rows), SPEC), SPEC)


@pytest.fixture
def place(spark):
    root = work_dir(spark)
    return f"bucketed_{root[-8:]}", f"{root}/curated"


def many(spark, ads, version, spend):
    rows = [{"account_id": a, "ad_id": str(i), "execution_date": version, "spend": spend} for a in ("A", "") for i in ads]
    return clean(spark, rows)


def above(plan: str, leaf: str) -> list[str]:
    """The operators between the root and the first line that holds ``leaf``."""
    lines = plan.split("\n")
    depth = [len(re.match(r"[ :|+-]*", line)[0]) for line in lines]
    at = next(i for i, line in enumerate(lines) if leaf in line)
    found, level = [], depth[at]
    for i in range(at - 1, -1, -1):
        if depth[i] < level:
            found.append(lines[i])
            level = depth[i]
    return found


def test_golden_upsert(spark, place):
    upsert_versioned(clean(spark, STORED), SPEC, *place, BUCKETS)
    for _ in range(2):
        result = upsert_versioned(clean(spark, INCOMING), SPEC, *place)
        assert (result.rows_read, result.rows_written, len(result.partitions)) == (3, 3, 1)
        assert short(spark.table(place[0])) == EXPECTED
    assert table_buckets(spark, place[0]) == Buckets(BUCKETS, SPEC.key)
    assert upsert_versioned(clean(spark, INCOMING[3:]), SPEC, *place).partitions == []
    assert versions.remove_unused(spark, *place, older_than_hours=0) == 2
    assert short(spark.table(place[0])) == EXPECTED


def test_stored_rows_are_not_shuffled(spark, place, monkeypatch):
    plans = []
    real = versioned.replace_partitions

    def seen(rows, *args, **named):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return real(rows, *args, **named)

    monkeypatch.setattr(versioned, "replace_partitions", seen)
    upsert_versioned(many(spark, range(200), "2024-01-03", "1"), SPEC, *place, BUCKETS)
    upsert_versioned(many(spark, range(100, 300), "2024-01-04", "2"), SPEC, *place)
    scan = "Bucketed: true"
    assert scan in plans[1] and "dynamicpruning" in plans[1].lower()
    path = above(plans[1], scan)
    assert any("Union" in line for line in path) and not any("Exchange" in line for line in path)
    spends = Counter((r.account_id, float(r.spend)) for r in spark.table(place[0]).collect())
    assert spends == Counter({("A", 1.0): 100, ("A", 2.0): 200, ("", 1.0): 100, ("", 2.0): 200})


def test_a_partition_has_a_file_for_each_bucket(spark, place):
    table, root = place
    upsert_versioned(many(spark, range(200), "2024-01-03", "1"), SPEC, *place, BUCKETS)
    names = glob.glob(f"{root.removeprefix('file:')}/versions/*/account=A/*/*/*/*.parquet")
    assert sorted(int(re.search(r"_(\d{5})\.c", name)[1]) for name in names) == list(range(BUCKETS))
    # Rows that are not placed by bucket yet are shuffled there.
    rows = project(with_partitions(many(spark, range(50), "2024-01-05", "7"), SPEC), spark.table(table).columns)
    replace_partitions(rows.repartition(7), table, root, PARTITIONS)
    assert {float(r.spend) for r in spark.table(table).collect()} == {7.0}
    assert spark.table(table).where(F.col("ad_id") == "33").count() == 2


def test_a_hot_key_is_one_row_before_it_goes_to_its_bucket(spark, place):
    upsert_versioned(clean(spark, STORED), SPEC, *place, BUCKETS)
    hot = [{"ad_id": "1", "execution_date": f"2024-02-{1 + i % 20:02d}", "spend": str(i % 20)} for i in range(500)]
    result = upsert_versioned(clean(spark, hot), SPEC, *place)
    assert (result.rows_read, result.rows_written) == (500, 2)
    found = {(r.account_id, r.ad_id): float(r.spend) for r in spark.table(place[0]).collect()}
    assert found == {("A", "1"): 19.0, ("A", "2"): 2.0, ("B", "1"): 3.0}


@pytest.mark.parametrize("step", ["write", "mark", "switch"])
def test_a_load_that_dies_leaves_the_table_whole(spark, place, monkeypatch, step):
    upsert_versioned(clean(spark, STORED), SPEC, *place, BUCKETS)
    before = short(spark.table(place[0]))

    def die(*args):
        raise KeyboardInterrupt(step)

    with monkeypatch.context() as patch:
        if step == "write":
            broken = clean(spark, INCOMING).withColumn("campaign_name", F.raise_error(F.lit("write")).cast("string"))
            with pytest.raises(Exception, match="write"):
                upsert_versioned(broken, SPEC, *place)
        else:
            patch.setattr(versions, step, die)
            with pytest.raises(KeyboardInterrupt):
                upsert_versioned(clean(spark, INCOMING), SPEC, *place)
    assert short(spark.table(place[0])) == before
    upsert_versioned(clean(spark, INCOMING), SPEC, *place)
    assert short(spark.table(place[0])) == EXPECTED


def test_tables_of_dead_loads_are_dropped(spark, place):
    table, root = place
    upsert_versioned(clean(spark, STORED), SPEC, *place, BUCKETS)
    left = f"{table}{versions.LOADING}{1:020d}_0123abcd"
    spark.sql(f"CREATE TABLE {left} (a int) USING parquet LOCATION '{root}-left'")
    versions.remove_unused(spark, table, root)
    assert not spark.catalog.tableExists(left) and spark.catalog.tableExists(table)
