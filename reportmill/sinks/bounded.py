"""The disk that large writes need beside their output."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from reportmill.session import MIB

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# A write that has a split of this size for every core fills the cluster by itself.
SPLIT_BYTES = 128 * MIB

_turn = threading.Condition()
_waiting: list[object] = []
_running: list[int] = []
_dropping: dict[int, tuple[int, str | None]] = {}


def planned_bytes(df: DataFrame) -> int:
    """Spark's estimate from the sizes of the files; very large where it has none."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


@contextmanager
def in_turn(size: int, room: int) -> Iterator[None]:
    """Let writes run side by side while they have ``room`` together, first come, first served; a larger one runs alone."""
    mine = object()
    with _turn:
        _waiting.append(mine)
        try:
            _turn.wait_for(lambda: _waiting[0] is mine and (not _running or sum(_running) + size <= room))
            _running.append(size)
        finally:
            _waiting.remove(mine)
            _turn.notify_all()
    try:
        yield
    finally:
        with _turn:
            _running.remove(size)
            _turn.notify_all()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that start meanwhile remove their shuffle files when they end.

    Otherwise these stay until the driver collects garbage, which it may never do during a run. The setting belongs to
    the session, so of several writes side by side the first one sets it and the last one puts it back.
    """
    session = spark._jsparkSession.hashCode()
    with _turn:
        users, before = _dropping.get(session) or (0, spark.conf.get(CLEANUP, None))
        _dropping[session] = (users + 1, before)
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _turn:
            users, before = _dropping.pop(session)
            if users > 1:
                _dropping[session] = (users - 1, before)
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


@contextmanager
def bounded(df: DataFrame) -> Iterator[None]:
    """For the write of ``df``: it runs beside others only while cores would be idle, and leaves no shuffle files.

    So the shuffle files on disk are those of a few small writes, or of a single large one.
    """
    spark = df.sparkSession
    with in_turn(planned_bytes(df), spark.sparkContext.defaultParallelism * SPLIT_BYTES), shuffles_dropped(spark):
        yield
