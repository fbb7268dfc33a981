from __future__ import annotations

import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from edges import TEXTS, edge_docs, no_docs, text_rows
from reportmill.llm import quality_rules, secret_scan


def measures(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    inside = {k + d for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(inside)


def test_measures_match_plain_python(spark):
    got = quality_rules.judge(edge_docs(spark)).select("row_id", *quality_rules.MEASURES, "base_failed", "kept").collect()
    want = Counter((i, *measures(t)) for i, t in text_rows())
    assert Counter(tuple(r)[:7] for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_host_verdicts_shrink_small_hosts_and_reject_bad_ones(spark):
    good = " ".join(f"w{k}" for k in range(60))
    rows = [(k, good, "good") for k in range(200)] + [(1000 + k, "short", "bad") for k in range(200)]
    rows += [(2000 + k, good, "bad") for k in range(20)] + [(3000, "short", "tiny"), (3001, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    measured = quality_rules.measure(docs)
    rates = {r["host"]: r for r in quality_rules.host_verdicts(measured).collect()}
    assert set(rates) == {"good", "bad", "tiny"}
    assert rates["bad"]["rejected"] and not rates["good"]["rejected"]
    assert rates["bad"]["rate_short"] < 200 / 220 and 0 < rates["good"]["rate_short"] < rates["tiny"]["rate_short"] < 1
    kept = {r["row_id"] for r in quality_rules.judge(docs).where("kept").collect()}
    assert kept == {*range(200), 3001}


def brute_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for kind, (_, pattern, group, least) in enumerate(
        [
            ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20),
            ("hex", r"[0-9a-f]+", 0, 24),
        ]
    ):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return sorted(out)


def test_secret_spans_match_plain_python(spark):
    got = secret_scan.scan(edge_docs(spark)).select("row_id", F.transform("base", lambda s: F.struct(s["start"], s["kind"], s["end"])).alias("b"), secret_scan.named("base").alias("n")).collect()
    assert Counter((r["row_id"], tuple(map(tuple, r["b"]))) for r in got) == Counter((i, tuple(brute_spans(t))) for i, t in text_rows())
    names = ("assign", "access", "hex")
    want = {i: ",".join(f"{names[k]}:{s}:{e}" for s, k, e in brute_spans(t)) for i, t in text_rows() if i is not None}
    assert {r["row_id"]: r["n"] for r in got if r["row_id"] is not None} == want
    assert hashlib.sha256(want[4].encode()).hexdigest() == hashlib.sha256(b"").hexdigest()


def test_ownership_separates_copied_examples_from_live_values(spark):
    live, example = "q7Zp0Xk3Vb9Lm2Rt5Yw8", "A1b2C3d4E5F6G7h8I9j0"
    rows = [(k, f"copied from the docs {example} here", f"owner{k}") for k in range(5)] + [(9, f"mine {live} here", "owner9")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["row_id"]: r for r in secret_scan.scan(docs).select("*", secret_scan.named("spans").alias("names")).collect()}
    assert got[9]["names"] == f"live:5:{5 + len(live)}" and got[9]["n_live"] == 1
    assert all(got[k]["names"] == "" and got[k]["n_example"] == 1 for k in range(5))


def test_a_value_in_very_many_documents_of_one_owner_is_an_example(spark):
    few, many = "q7Zp0Xk3Vb9Lm2Rt5Yw8", "A1b2C3d4E5F6G7h8I9j0"
    rows = [(k, f"one {few}" if k < 5 else f"other {many}", "owner") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["row_id"]: (r["n_live"], r["n_example"]) for r in secret_scan.scan(docs).collect()}
    assert got == {k: (1, 0) if k < 5 else (0, 1) for k in range(60)}


def test_a_token_that_reaches_beyond_a_base_span_is_cut_as_a_whole(spark):
    token = "Zk9" + "0123456789abcdef01234567" + "XyQ7Lm2Pw8"
    rows = [(1, f"see {token} here", "a", "x"), (2, f"password={token[:30]} tail", "a", "x"), (3, "nothing", "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, spans_ string")
    names = {r["row_id"]: r["names"] for r in secret_scan.scan(docs).select("row_id", secret_scan.named("spans").alias("names")).collect()}
    assert names[1] == f"live:4:{4 + len(token)},hex:6:31" and names[2].startswith("assign:0:39")
    assert {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()} == {1: "see [SECRET] here", 2: "[SECRET] tail", 3: "nothing"}


def test_redaction_cuts_every_span_and_nothing_else(spark):
    docs = edge_docs(spark)
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns and out.count() == len(TEXTS)
    rows = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    assert "A1b2C3d4E5" not in rows[12]["text"] and "AKIA" not in rows[12]["text"] and "0123456789abcdef" not in rows[12]["text"]
    assert rows[12]["text"].startswith("Password: abc; [SECRET]") and rows[12]["n_chars"] == len(rows[12]["text"])
    assert rows[4]["text"] is None and rows[9]["text"] == dict(TEXTS[9:10])[9] and rows[1]["n_chars"] is None


def test_empty_tables(spark):
    assert quality_rules.judge(no_docs(spark)).count() == 0
    assert secret_scan.scan(no_docs(spark)).count() == 0
    assert secret_scan.redact(no_docs(spark)).count() == 0


def test_rules_and_secrets_run_without_python_workers(spark):
    for df in (quality_rules.measure(edge_docs(spark)), secret_scan.find_spans(edge_docs(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
