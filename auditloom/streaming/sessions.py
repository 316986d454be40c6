"""Session windows as keyed state, with late rows as an output of their own.

A key's rows are one session while less than ``gap`` lies between them. A key's rows may
come out of order by ``delay``: a row older than that, against what the key gave in earlier
batches, is late and comes out as such, counted in no session. A session is given once, when
no row that is not late can join it any more; rows with ``closing`` end all of their key's. State is
what lies within ``delay`` and ``gap`` of a key's latest row. Keys are kept and followed by
buckets, as a call and its state cost the same for one key as for hundreds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from auditloom.streaming.monitor import _list_state

#: Groups of keys, by hash; a folder's state holds for one number of them.
BUCKETS = 1024
NEVER = -(1 << 62)
OUT = "key string, start timestamp, end timestamp, n long, total double, kind string"


class _Sessions(StatefulProcessor):
    """Sessions of all keys of a bucket at once; times are microseconds here."""

    def __init__(self, gap: float, delay: float) -> None:
        self.gap, self.delay = round(gap * 1e6), round(delay * 1e6)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "key array<string>, start array<long>, end array<long>, n array<long>, total array<double>")
        self.latest = handle.getValueState("latest", "key array<string>, at array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        given = pd.concat(list(rows), ignore_index=True)
        ends = given["closing"].astype(bool)
        closing = set(given.loc[ends, "key"])
        given = given[~ends & given["at"].notna()].sort_values(["key", "at", "value"], kind="stable")
        at = given["at"].to_numpy().astype("datetime64[us]").astype(np.int64)
        new = pd.DataFrame({"key": given["key"].to_numpy(), "start": at, "end": at, "n": 1, "total": given["value"].to_numpy()})
        latest = dict(zip(*self.latest.get(), strict=True)) if self.latest.exists() else {}
        is_late = at < np.array([latest.get(k, NEVER) for k in new["key"]], dtype=np.int64) - self.delay
        late, new = new[is_late].assign(kind="late"), new[~is_late]
        if len(new):
            latest |= {k: max(t, latest.get(k, NEVER)) for k, t in new.groupby("key")["end"].max().items()}
            self.latest.update((list(latest), [int(t) for t in latest.values()]))
        held = pd.DataFrame(dict(zip(new.columns, self.open.get(), strict=True))) if self.open.exists() else new.iloc[:0]
        parts = pd.concat([held, new], ignore_index=True) if len(held) else new
        parts = parts.sort_values(["key", "start", "end"], kind="stable", ignore_index=True)
        # A session begins where a key does, or gap or more behind all that its key had before.
        before = parts.groupby("key")["end"].cummax().shift()
        first = (parts["key"] != parts["key"].shift()) | (parts["start"] >= before.fillna(0).astype("int64") + self.gap)
        merged = parts.groupby(first.cumsum()).agg({"key": "first", "start": "min", "end": "max", "n": "sum", "total": "sum"})
        reached = np.array([latest[k] for k in merged["key"]], dtype=np.int64) - self.delay
        done = merged["key"].isin(closing).to_numpy() | (merged["end"].to_numpy() + self.gap <= reached)
        rest = merged[~done]
        if len(rest):
            self.open.update(tuple(rest[c].tolist() for c in rest.columns))
        elif self.open.exists():
            self.open.clear()
        out = pd.concat([late, merged[done].assign(kind="closed")], ignore_index=True)
        yield out.assign(start=out["start"].to_numpy().astype("datetime64[us]"), end=out["end"].to_numpy().astype("datetime64[us]"))

    def close(self) -> None:
        pass


def sessions(rows: DataFrame, folder: str, gap: float, delay: float) -> DataFrame:
    """All ``key, start, end, n, total, kind`` so far, after the stream ``rows(key, at, value, closing)`` has been followed to its end.

    ``gap`` and ``delay`` are in seconds. A null value counts as 0, a null key or time not at
    all. ``folder`` holds the state and the rows; another call with it goes on from there.
    """
    spark = rows.sparkSession
    known = rows.where("key IS NOT NULL").select(F.col("key").cast("string").alias("key"), "at", F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"), F.coalesce("closing", F.lit(False)).alias("closing"))
    with _list_state(spark):
        found = known.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS))).groupBy("bucket").transformWithStateInPandas(_Sessions(gap, delay), outputStructType=OUT, outputMode="Append", timeMode="None")
        found.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(OUT).parquet(f"{folder}/rows")
