"""A monitor of sources as keyed state: what is new against each source's latest items, kept over restarts.

A micro-batch is a poll: the items that sources gave then. For each source the state store
keeps its latest items, newest first, when it was last heard and how many it has given, and
an event-time timer for its cadence. A poll that a source failed leaves its cursor where it
was, so the next one starts from there; a source that stays silent longer than its cadence
gives a row when the watermark passes. State of one source is bounded by ``keep`` items.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from auditloom.operators.retrieve import bare_id

OUT = "source string, item string, at timestamp, kind string, total long"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def _list_state(spark: SparkSession):
    """Keyed lists and timers need the store that keeps them outside the heap."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


class _Cursor(StatefulProcessor):
    def __init__(self, keep: int, cadence_days: float) -> None:
        self.keep, self.cadence = keep, int(cadence_days * 86_400_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "item string")
        self.heard = handle.getValueState("heard", "at timestamp, total long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        polled = pd.concat(list(rows), ignore_index=True)
        at, total = self.heard.get() if self.heard.exists() else (None, 0)
        failed = polled[polled["error"].notna()]
        if len(failed):
            yield pd.DataFrame({"source": [key[0]], "item": [failed["error"].min()], "at": [failed["at"].max()], "kind": ["error"], "total": [total]})
            return
        # Newest first, items of one time by name; an item counts once a poll, at its latest time.
        polled = polled[polled["item"].notna()].sort_values(["at", "item"], ascending=[False, True], kind="stable").drop_duplicates("item")
        held = [r[0] for r in self.seen.get()] if self.seen.exists() else []
        fresh = polled[~polled["item"].isin(held)]
        if len(fresh):
            self.seen.put([(x,) for x in (fresh["item"].tolist() + held)[: self.keep]])
        if len(polled):
            latest = polled["at"].max() if at is None else max(polled["at"].max(), pd.Timestamp(at))
            total += len(fresh)
            self.heard.update((latest.to_pydatetime(), total))
            for t in self.handle.listTimers():
                self.handle.deleteTimer(t)
            self.handle.registerTimer(int(latest.timestamp() * 1000) + self.cadence)
        yield pd.DataFrame({"source": key[0], "item": fresh["item"], "at": fresh["at"], "kind": "new", "total": total})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, total = self.heard.get()
        yield pd.DataFrame({"source": [key[0]], "item": [None], "at": [pd.Timestamp(at)], "kind": ["silent"], "total": [total]})

    def close(self) -> None:
        pass


def monitor(polls: DataFrame, folder: str, keep: int = 200, cadence_days: float = 7, late: str = "0 seconds") -> DataFrame:
    """All rows so far, after the stream ``polls(source, item, at, error)`` has been followed to its end.

    ``kind`` is new for items that were not among the source's ``keep`` latest, versions left
    out, error for polls that failed, silent for a cadence without items. ``folder`` holds the
    state and the rows; another call with it goes on from there.
    """
    spark = polls.sparkSession
    rows = polls.where("source IS NOT NULL").select("source", bare_id(F.col("item")).alias("item"), "at", "error").withWatermark("at", late)
    with _list_state(spark):
        found = rows.groupBy("source").transformWithStateInPandas(_Cursor(keep, cadence_days), outputStructType=OUT, outputMode="Append", timeMode="EventTime")
        found.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(OUT).parquet(f"{folder}/rows")
