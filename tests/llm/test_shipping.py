"""Workers that do not find the package by themselves, and an entry without a library of the document queries."""

from __future__ import annotations

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = """
import sys
sys.path.insert(0, {repo!r})
from reportmill.session import build_session
spark = build_session("ship", "local[4]", **{{"spark.ui.enabled": "false", "spark.driver.memory": "4g"}})
import __spark_entry__ as e
for name, query in e.queries().items():
    if name.startswith("op") and not name.startswith("op4_"):
        assert query(spark, "/root/testdata/sf0.001").count() > 0, name
        print("ran", name, flush=True)
"""
WITHOUT = """
import sys
sys.path.insert(0, {repo!r})
sys.modules["xxhash"] = None
import __spark_entry__ as e
names = set(e.queries())
assert "curate_events" in names and not any(n.startswith("op") for n in names) and set(e.oracle_sql()) <= names
print("without", len(names))
"""


def python(code: str, folder) -> str:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code.format(repo=REPO)], cwd=folder, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


def test_queries_run_from_another_folder(tmp_path):
    out = python(RUN, tmp_path)
    assert out.count("ran op") == 12


def test_the_entry_works_without_a_library_of_the_document_queries(tmp_path):
    assert "without" in python(WITHOUT, tmp_path)
