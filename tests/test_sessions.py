"""Session windows over several batches, rows out of order and late ones, against a plain walk."""

from datetime import datetime, timedelta

import numpy as np

from auditloom.sources.scratch import scratch_path
from auditloom.streaming import sessions as module
from auditloom.streaming.sessions import sessions

SCHEMA = "key string, at timestamp, value double, closing boolean"
START, GAP, DELAY = datetime(2024, 1, 1), 600, 900


def plain(batches):
    """Sessions of the rows that aren't late, and the late rows."""
    latest, kept, late = {}, {}, []
    for batch in batches:
        before = dict(latest)
        for key, at, value, closing in batch:
            if key is None or at is None or closing:
                continue
            if key in before and at < before[key] - timedelta(seconds=DELAY):
                late.append((key, at, value or 0.0))
            else:
                kept.setdefault(key, []).append((at, value or 0.0))
                latest[key] = max(latest.get(key, at), at)
    out = []
    for key, rows in kept.items():
        for at, value in sorted(rows):
            if out and out[-1][0] == key and at < out[-1][2] + timedelta(seconds=GAP):
                out[-1][2], out[-1][3], out[-1][4] = at, out[-1][3] + 1, out[-1][4] + value
            else:
                out.append([key, at, at, 1, value])
    return sorted((k, a, b, n, round(t, 6)) for k, a, b, n, t in out), sorted(late)


def test_sessions(spark):
    rng = np.random.default_rng(8)
    batches = []
    for b in range(4):
        times = b * 4000 + rng.integers(-2500, 4000, 60)
        batches.append([(f"k{k}", START + timedelta(seconds=int(10_000 + t)), float(v), False) for k, t, v in zip(rng.integers(0, 4, 60), times, rng.integers(0, 9, 60), strict=True)])
    batches[1] += [(None, START, 1.0, False), ("k0", None, 1.0, False), ("k9", START, None, None)]
    batches.append([(f"k{k}", None, None, True) for k in (0, 1, 2, 3, 9)])
    folder = scratch_path(spark, "sessions")
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).repartition(2).write.mode("append").parquet(f"{folder}/in")
        out = sessions(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), folder, GAP, DELAY)
    rows = out.collect()
    closed, late = plain(batches)
    assert late and len(closed) > 10
    assert sorted((r.key, r.start, r.end, r.n, round(r.total, 6)) for r in rows if r.kind == "closed") == closed
    assert sorted((r.key, r.start, r.total) for r in rows if r.kind == "late") == late


def test_many_keys_of_few_buckets(spark, monkeypatch):
    """State is followed by bucket: keys of one bucket don't touch each other, whether they have rows in a batch or not."""
    monkeypatch.setattr(module, "BUCKETS", 2)
    rng = np.random.default_rng(9)
    batches = []
    for b in range(3):
        times, keys = b * 4000 + rng.integers(-2500, 4000, 150), rng.integers(0, 12 + 6 * b, 150)
        batches.append([(f"k{k}", START + timedelta(seconds=int(10_000 + t)), float(v), False) for k, t, v in zip(keys, times, rng.integers(0, 9, 150), strict=True)])
    batches.append([(f"k{k}", None, None, True) for k in range(24)])
    folder = scratch_path(spark, "sessions")
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).repartition(2).write.mode("append").parquet(f"{folder}/in")
        out = sessions(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), folder, GAP, DELAY)
    rows = out.collect()
    closed, late = plain(batches)
    assert late and sorted((r.key, r.start, r.end, r.n, round(r.total, 6)) for r in rows if r.kind == "closed") == closed
    assert sorted((r.key, r.start, r.total) for r in rows if r.kind == "late") == late
