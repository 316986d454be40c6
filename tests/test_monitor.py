"""The monitor as keyed state, with a restart before every poll, against its plain rules."""

from datetime import datetime, timedelta

import pytest

from auditloom.sources.scratch import scratch_path
from auditloom.streaming.monitor import monitor

SCHEMA = "source string, item string, at timestamp, error string"
START = datetime(2024, 1, 1)


def day(n, hour=0):
    return START + timedelta(days=n, hours=hour)


POLLS = [
    [("a", "1v1", day(0), None), ("a", "2", day(0, 1), None), ("b", "x", day(0), None), (None, "y", day(0), None), ("a", None, day(0), None)],
    [("a", "1v2", day(2), None), ("a", "3", day(2), None), ("a", "3v9", day(2, 1), None), ("b", "z", day(2), "network")],
    [("a", "4", day(4), None), ("a", "5", day(4), None), ("b", "x", day(4), None), ("b", "z", day(4), None)],
    [("a", "1", day(13), None), ("a", "5", day(13), None), ("c", "q", day(13), None)],
    [("c", "q", day(14), None)],
]


@pytest.fixture(scope="module")
def rows(spark):
    folder = scratch_path(spark, "monitor")
    for poll in POLLS:
        spark.createDataFrame(poll, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/polls")
        out = monitor(spark.readStream.schema(SCHEMA).parquet(f"{folder}/polls"), folder, keep=3, cadence_days=7)
    return [tuple(r) for r in out.collect()]


def test_new_items(rows):
    """Only three items of a source are remembered: item 1 is new again after three others."""
    new = sorted((s, i, t) for s, i, t, kind, _ in rows if kind == "new")
    assert new == sorted([
        ("a", "1", day(0)), ("a", "2", day(0, 1)), ("b", "x", day(0)), ("a", "3", day(2, 1)), ("a", "4", day(4)), ("a", "5", day(4)), ("b", "z", day(4)), ("a", "1", day(13)), ("c", "q", day(13)),
    ])


def test_a_failed_poll_moves_nothing(rows):
    assert [(s, i, n) for s, i, _, kind, n in rows if kind == "error"] == [("b", "network", 1)]


def test_silent_sources(rows):
    silent = [(s, t) for s, _, t, kind, _ in rows if kind == "silent"]
    assert ("b", day(4)) in silent and ("c", day(14)) not in silent
