from __future__ import annotations

import glob
import os
import threading
import time

import pytest
from pyspark.sql import DataFrameWriter

from reportmill.plans.curate import curate_frame, curate_report
from reportmill.session import work_dir
from reportmill.sinks import bounded, partitioned
from reportmill.sources import scan_curated
from reportmill.spec import REPORTS
from rows import EXPECTED, INCOMING, SPEC, STORED, raw_rows, short
from workloads import inputs
from workloads.queries import family_runs


def shuffle_files(spark) -> set[str]:
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for folder in store.localDirsString() for name in glob.glob(f"{folder}/*/shuffle_*")}


def test_an_upsert_leaves_no_shuffle_files(spark, monkeypatch):
    target = f"{work_dir(spark)}/curated"
    spark.conf.unset(bounded.CLEANUP)
    rows = [{"ad_id": str(n), "ad_name": f"{n * n} {n}", "execution_date": "2024-01-04", "spend": "1"} for n in range(5000)]
    plain, during = DataFrameWriter.parquet, []

    def write(writer, *args, **options):
        during.append(spark.conf.get(bounded.CLEANUP, None))
        return plain(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    before = shuffle_files(spark)
    for _ in range(2):
        curate_frame(raw_rows(spark, rows), SPEC, target)
    assert scan_curated(spark, SPEC, target).count() == 5000
    # What is left is that of the lists of partitions, which do not hold the rows.
    left = [os.path.getsize(name) for name in shuffle_files(spark) - before if name.endswith(".data")]
    assert sum(left) < 5_000
    assert during == ["true", "true"]
    assert spark.conf.get(bounded.CLEANUP, None) is None


def test_the_setting_is_put_back_by_the_last_write(spark):
    spark.conf.set(bounded.CLEANUP, "false")
    try:
        with bounded.shuffles_dropped(spark):
            with pytest.raises(ValueError), bounded.shuffles_dropped(spark):
                raise ValueError
            assert spark.conf.get(bounded.CLEANUP) == "true"
        assert spark.conf.get(bounded.CLEANUP) == "false"
    finally:
        spark.conf.unset(bounded.CLEANUP)


def side_by_side(sizes: list[int], room: int) -> list[int]:
    """The most bytes under way at once, and the most writes."""
    lock, now, most = threading.Lock(), [], [0, 0]

    def write(size):
        with bounded.in_turn(size, room):
            with lock:
                now.append(size)
                most[:] = max(most[0], sum(now)), max(most[1], len(now))
            time.sleep(0.05)
            with lock:
                now.remove(size)

    threads = [threading.Thread(target=write, args=(size,)) for size in sizes]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join(30)
    assert not any(thread.is_alive() for thread in threads)
    return most


def test_large_writes_take_turns_and_small_ones_do_not():
    assert side_by_side([100] * 4, room=10) == [100, 1]
    assert side_by_side([1] * 4, room=10) == [4, 4]
    assert side_by_side([6] * 4 + [3] * 4, room=10)[0] <= 10


def test_a_failed_write_gives_its_turn_away():
    with pytest.raises(ValueError), bounded.in_turn(100, 10):
        raise ValueError
    assert side_by_side([100] * 2, room=10) == [100, 1]


def test_a_report_waits_for_its_turn(spark, monkeypatch):
    """Two loads at once that do not fit together: their writes do not overlap, and both come out whole."""
    root, spans = work_dir(spark), []
    plain = bounded.shuffles_dropped

    class Watched:
        def __init__(self, session):
            self.inner = plain(session)

        def __enter__(self):
            spans.append("begin")
            return self.inner.__enter__()

        def __exit__(self, *error):
            spans.append("end")
            return self.inner.__exit__(*error)

    monkeypatch.setattr(bounded, "SPLIT_BYTES", 0)
    monkeypatch.setattr(bounded, "shuffles_dropped", Watched)
    assert partitioned.bounded is bounded.bounded
    loads = [
        threading.Thread(target=curate_frame, args=(raw_rows(spark, STORED + INCOMING), SPEC, f"{root}/{number}"))
        for number in range(3)
    ]
    for load in loads:
        load.start()
    for load in loads:
        load.join()
    assert spans == ["begin", "end"] * 3
    assert [short(scan_curated(spark, SPEC, f"{root}/{number}")) for number in range(3)] == [EXPECTED] * 3


def test_compressed_landing_is_read_in_full_by_several_tasks(spark):
    root = work_dir(spark)
    rows = [{"ad_id": str(n), "ad_name": f'a "{n}", b', "execution_date": "2024-01-04", "spend": str(n)} for n in range(1000)]
    raw = raw_rows(spark, rows).coalesce(1)
    landed = inputs.land_csv(raw, f"{root}/raw", **{**inputs.COMPRESSED, "maxRecordsPerFile": 100})
    files = glob.glob(f"{landed.removeprefix('file:')}/*.csv.snappy")
    assert len(files) == 10
    assert curate_report(spark, SPEC, landed, f"{root}/curated").rows_read == 1000
    stored = {(r.ad_id, r.ad_name, int(r.spend)) for r in scan_curated(spark, SPEC, f"{root}/curated").collect()}
    assert stored == {(str(n), f'a "{n}", b', n) for n in range(1000)}


def test_the_family_lands_compressed_files(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, 1, "BUILDING")], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, "FRANCE", 3)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(3, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    spark.sql(
        "SELECT id AS event_id, timestamp'2024-01-02 03:04:05' AS ts, id % 2 AS user_id, 'view' AS event_type, 1.5D AS value, "
        "'{\"k\": 7}' AS props FROM range(10)"
    ).write.parquet(f"{tmp_path}/events.parquet")
    landed, plain = [], inputs.land_csv
    monkeypatch.setattr(inputs, "land_csv", lambda df, path, **options: landed.append(plain(df, path, **options)) or landed[-1])
    runs = family_runs(spark, str(tmp_path), tuple(spec for spec in REPORTS if spec.report_type == "region"))
    files = [name for name in os.listdir(landed[0].removeprefix("file:")) if name.startswith("part-")]
    assert files and all(name.endswith(".csv.snappy") for name in files)
    assert [(run.curated.rows_read, run.curated.rows_written) for run in runs] == [(10, 2)]
