"""Loads that may be repeated, mixed headers, publication by views, and the run ledger."""

from __future__ import annotations

import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from reportmill.plans.family import ReportsFailed, run_family, run_report
from reportmill.plans.warehouse import batch_of_files, load_report_once
from reportmill.session import work_dir
from reportmill.sinks.catalog import publish
from reportmill.sinks.export import export_sorted, land_by_day
from reportmill.sinks.warehouse import load_batch, loads
from reportmill.sources import first_file, report_path, scan_delimited
from reportmill.sources.headers import header_groups, scan_by_header
from reportmill.spec import AFFILIATE_MAPPING, REPORTS
from reportmill.streaming.incremental import load_new_files
from rows import STORED, raw_rows

MAPPING = [("Id", "id", "int"), ("Spend", "spend", "decimal(18,5)")]


def local(path):
    return path.removeprefix("file:")


def write_file(path, text):
    os.makedirs(os.path.dirname(local(path)), exist_ok=True)
    with open(local(path), "w", newline="") as handle:
        handle.write(text)


@pytest.fixture
def place(spark):
    root = work_dir(spark)
    return root, f"loads_{root[-8:]}"


def ids(spark, table):
    return sorted(r.id for r in spark.table(table).select("id").collect())


def test_the_same_batch_twice_is_there_once(spark, place):
    root, table = place
    write_file(f"{root}/raw/a.csv", "Id,Spend\n1,1.5\n2,x\n")
    for _ in range(3):
        assert load_report_once(spark, MAPPING, f"{root}/raw", table, f"{root}/t") == 2
    assert ids(spark, table) == [1, 2] and len(loads(spark, table)) == 1
    write_file(f"{root}/more/b.csv", "Id,Spend\n2,1\n")
    load_report_once(spark, MAPPING, f"{root}/more", table, f"{root}/t")
    assert ids(spark, table) == [1, 2, 2] and len(loads(spark, table)) == 2
    assert load_report_once(spark, MAPPING, f"{root}/nothing", table, f"{root}/t") == 0
    assert batch_of_files(spark, f"{root}/raw") != batch_of_files(spark, f"{root}/more")


def test_a_repeated_load_replaces_its_rows(spark, place):
    root, table = place
    frame = spark.createDataFrame([(1,), (2,)], "id int")
    load_batch(frame, table, root, "monday")
    load_batch(frame.where("id = 1"), table, root, "tuesday")
    load_batch(frame.where("id = 2"), table, root, "monday")
    assert ids(spark, table) == [1, 2]
    with pytest.raises(Exception, match="broken"):
        load_batch(frame.select(F.raise_error(F.lit("broken")).cast("int").alias("id")), table, root, "monday")
    assert ids(spark, table) == [1, 2] and loads(spark, table) == ["monday", "tuesday"]


def test_new_files_are_loaded_once_even_when_a_batch_is_replayed(spark, place):
    root, table = place
    args = (MAPPING, f"{root}/raw", table, f"{root}/t", f"{root}/checkpoint")
    load_new_files(spark, *args)
    assert not spark.catalog.tableExists(table)
    for number in (1, 2, 3):
        write_file(f"{root}/raw/{number}.csv", f"Id,Spend\n{number},1\n{number * 10},2\n")
        load_new_files(spark, *args)
        if number == 2:
            # The second batch was written, but its commit was lost: it runs again.
            newest = max(glob.glob(f"{local(root)}/checkpoint/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
            os.remove(newest)
            os.remove(os.path.join(os.path.dirname(newest), f".{os.path.basename(newest)}.crc"))
            load_new_files(spark, *args)
    assert ids(spark, table) == [1, 2, 3, 10, 20, 30]
    assert len(loads(spark, table)) == 3


def test_files_with_permuted_headers_in_one_folder(spark, place):
    root, _ = place
    write_file(f"{root}/raw/a.csv", "id,v\n1,2\n")
    write_file(f"{root}/raw/deep/b.csv", 'v,"id"\n4,3\n')
    write_file(f"{root}/raw/deep/odd name%20{{x}}.csv", '"w, x",id\n9,5\n')
    write_file(f"{root}/raw/empty.csv", "")
    write_file(f"{root}/raw/only_header.csv", "v,id\n")
    write_file(f"{root}/raw/_hidden/c.csv", "v,id\n7,7\n")
    rows = scan_by_header(spark, f"{root}/raw")
    assert sorted((r["id"], r["v"], r["w, x"]) for r in rows.collect()) == [("1", "2", None), ("3", "4", None), ("5", None, "9")]
    assert {names: len(files) for names, files in header_groups(spark, f"{root}/raw").items()} == {("id", "v"): 1, ("v", "id"): 2, ("w, x", "id"): 1}
    assert scan_by_header(spark, f"{root}/nothing") is None


def test_the_header_index_does_not_read_files_through(spark, place):
    root, _ = place
    body = "".join(f"{k},{k}\n" for k in range(300_000))
    for name, header in (("a", "x,y"), ("b", "y,x")):
        write_file(f"{root}/raw/{name}.csv", f"{header}\n{body}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        assert set(header_groups(spark, f"{root}/raw")) == {("x", "y"), ("y", "x")}
        rows = scan_by_header(spark, f"{root}/raw")
        assert rows.where("x = '17'").count() == 2 and rows.count() == 600_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_hidden_folders_hold_no_files(spark, place):
    root, _ = place
    write_file(f"{root}/raw/_temporary/0/p.csv", "a\n1\n")
    write_file(f"{root}/raw/.staging/p.csv", "a\n1\n")
    assert first_file(spark, f"{root}/raw") is None
    write_file(f"{root}/raw/_k=1/p.csv", "a\n1\n")
    assert first_file(spark, f"{root}/raw").endswith("_k=1/p.csv")


def test_rows_without_a_day_are_landed_and_read_back(spark, place):
    root, _ = place
    rows = spark.sql("SELECT * FROM VALUES (1, timestamp'2024-01-02 03:04:05'), (2, null), (3, null), (4, timestamp'2024-11-12 00:00:00') AS t(id, ts)")
    write_file(f"{root}/days/year=2023/month=01/day=01/part-00000.csv", "id,ts\n9,2023-01-01 00:00:00\n")
    land_by_day(rows, f"{root}/days", "ts")
    read = spark.read.option("header", True).csv(f"{root}/days")
    assert sorted((r.id, r.day) for r in read.collect()) == [("1", "02"), ("2", None), ("3", None), ("4", "12"), ("9", "01")]
    names = sorted(os.path.basename(p) for p in glob.glob(f"{local(root)}/days/*/*/*/*.csv"))
    # Only what was written is renamed.
    assert names == ["2024-01-02-00000.csv", "2024-11-12-00000.csv", "part-00000.csv", *[n for n in names if n.startswith("undated")]] and len(names) > 3


def test_line_breaks_are_read_back(spark, place):
    root, _ = place
    rows = spark.createDataFrame([(1, "a\nb"), (2, 'q"\n\n"'), (3, "plain"), (4, "x\n")], "id int, text string")
    export_sorted(rows, f"{root}/out", "id")
    read = scan_delimited(spark, f"{root}/out", multiLine=True)
    assert [tuple(r) for r in read.collect()] == [("1", "a\nb"), ("2", 'q"\n\n"'), ("3", "plain"), ("4", "x\n")]


def test_a_published_name_is_never_missing(spark, place):
    root, _ = place
    tag = root[-6:]
    environments = (f"dev_{tag}", f"prd_{tag}")
    frames = [spark.range(3).toDF("n"), spark.range(4).selectExpr("count(*) AS n"), spark.range(5).selectExpr("id AS `dotted.name`", "1 AS one")]
    views = publish(frames[0], "steady", root, environments)
    missing, stop, seen = [], threading.Event(), [0]

    def watch():
        while not stop.is_set():
            for view in views:
                if not spark.catalog.tableExists(view):
                    missing.append(view)
                seen[0] += 1

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        for frame in frames[1:] * 2:
            publish(frame, "steady", root, environments)
    finally:
        stop.set()
        watcher.join()
    assert not missing and seen[0] > 20
    for view in views:
        assert spark.table(view).columns == ["dotted.name", "one"] and spark.table(view).count() == 5
    # The last publication and the one before it are kept.
    assert len(os.listdir(f"{local(root)}/{environments[0]}/steady")) == 2


def test_a_failing_switch_leaves_the_first_environment_ahead(spark, place, monkeypatch):
    from reportmill.sinks import catalog

    root, _ = place
    tag = root[-6:]
    environments = (f"dev_{tag}", f"prd_{tag}")
    views = publish(spark.range(3).toDF("n"), "ahead", root, environments)
    real = catalog.point_view

    def fail(spark, view, query):
        if view.startswith("prd"):
            raise RuntimeError("switch")
        real(spark, view, query)

    monkeypatch.setattr(catalog, "point_view", fail)
    with pytest.raises(RuntimeError, match="switch"):
        publish(spark.range(7).toDF("n"), "ahead", root, environments)
    assert [spark.table(v).count() for v in views] == [7, 3]


def test_a_table_from_before_becomes_a_view(spark, place):
    root, _ = place
    tag = root[-6:]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS dev_{tag}")
    spark.range(2).write.option("path", f"{root}/old").saveAsTable(f"dev_{tag}.older")
    publish(spark.range(9), "older", root, (f"dev_{tag}",))
    assert spark.table(f"dev_{tag}.older").count() == 9


def test_one_broken_report_neither_stops_nor_is_skipped(spark, place):
    root, _ = place
    tag = root[-6:]
    specs = [s for s in REPORTS if s.report_type in ("region", "dma", "country")]
    ran = []

    def land(spec, **extra):
        raw = raw_rows(spark, STORED).withColumns({name: F.lit("b") for name in spec.breakdowns} | extra)
        raw.write.mode("overwrite").option("header", True).csv(report_path(f"{root}/raw", "web", spec.report_type))

    def counted(spark, spec, *args):
        ran.append(spec.report_type)
        if broken and spec.report_type == "dma":
            raise ValueError("bad file\nsecond line")
        return run_report(spark, spec, *args)

    def run(run_id):
        ran.clear()
        return run_family(
            spark, "web", f"{root}/raw", f"{root}/curated", f"{root}/marts", specs, curated_db=f"c_{tag}",
            environments=(f"d_{tag}", f"p_{tag}"), run_one=counted, ledger=f"{root}/ledger", run_id=run_id,
        )

    for spec in specs:
        land(spec)
    broken = True
    with pytest.raises(ReportsFailed, match="dma: bad file") as failure:
        run("monday")
    assert sorted(ran) == ["country", "dma", "region"]
    results = {r.report_type: r for r in failure.value.runs}
    assert results["dma"].error == "bad file" and results["region"].curated.rows_written == 3
    assert spark.table(results["country"].monitoring).count() == 2
    broken = False
    again = {r.report_type: r for r in run("monday")}
    assert ran == ["dma"] and again["dma"].error is None
    assert again["region"].marts == results["region"].marts and again["region"].curated.rows_written == 3
    run("monday")
    assert ran == []
    run("tuesday")
    assert sorted(ran) == ["country", "dma", "region"]


def test_the_mapped_load_keeps_its_types(spark, place):
    root, table = place
    values = {source: "1.5" if kind != "string" else "s" for source, _, kind in AFFILIATE_MAPPING}
    raw = spark.createDataFrame([tuple(values.values())], ", ".join(f"`{n}` string" for n in values))
    raw.write.option("header", True).csv(f"{root}/raw")
    load_report_once(spark, AFFILIATE_MAPPING, f"{root}/raw", table, f"{root}/t", load_id="it's a/b")
    stored = spark.table(table)
    assert stored.columns == [*[target for _, target, _ in AFFILIATE_MAPPING], "load_id"]
    assert (stored.first().clicks, str(stored.first().revenue_gross), stored.first().load_id) == (1, "1.50000", "it's a/b")
