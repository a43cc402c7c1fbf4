"""Recent ratings kept by the stream: each user's newest ``k`` messages, as
keyed state.

A stateful processor holds one list of at most ``k`` ratings a user in Spark's
state store.  A micro-batch touches the lists of its own users only, and the
lists that changed go to a ``KeyedLog``; no stored table is read.  State and
offsets are committed together, so a replayed batch finds the lists as they
were before it and writes the same rows to its own partition.

Before the shuffle each task cuts every user's rows to the newest ``k`` per
Arrow batch, so a flooding user is spread over the map side.
"""

from __future__ import annotations

import heapq
import itertools
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ratingflow.sinks.tables import KeyedLog

# the processor runs in Python workers; executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COLUMNS = ("uid", "mid", "score", "timestamp")
ITEM = "mid int, score double, timestamp int"
LISTS = f"uid int, pos int, {ITEM}"
STATE = "newest"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _order(item) -> tuple:
    """Newest first; equal times by movie, then score."""
    return -item[2], item[0], item[1]


class NewestRatings(StatefulProcessor):
    """Keeps the newest ``k`` ratings of a user and gives the list back
    whenever it gets rows."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getListState(STATE, ITEM)

    def _keep(self, rows: Iterator) -> list[tuple]:
        held = [tuple(x) for x in self.newest.get()] if self.newest.exists() else []
        new = ((r["mid"], r["score"], r["timestamp"]) for r in rows)
        # one pass over the rows, k items in memory
        best = heapq.nsmallest(self.k, itertools.chain(held, new), key=_order)
        self.newest.put(best)
        return best

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for pos, (mid, score, timestamp) in enumerate(self._keep(rows), 1):
            yield Row(uid=key[0], pos=pos, mid=mid, score=score, timestamp=timestamp)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._keep([initialState])

    def close(self) -> None:
        pass


def cut_to_newest(messages: DataFrame, k: int) -> DataFrame:
    """The newest ``k`` rows of a user in every Arrow batch, before any shuffle."""
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            order = frame.sort_values(["timestamp", "mid", "score"], ascending=[False, True, True], kind="stable")
            yield order.groupby("uid", sort=False).head(k)
    return messages.select(*COLUMNS).mapInPandas(cut, f"uid int, {ITEM}")


def newest_lists(messages: DataFrame, k: int = 20, initial: DataFrame | None = None) -> DataFrame:
    """(uid, pos, mid, score, timestamp) of the users of each micro-batch of
    ``messages`` (uid, mid, score, timestamp): their newest ``k`` so far, order
    timestamp desc, mid asc, score asc.

    ``initial`` (same columns): ratings that are in the lists before the first
    batch; read once, when the stream starts from nothing."""
    seed = cut_to_newest(initial, k).groupBy("uid") if initial is not None else None
    return cut_to_newest(messages, k).groupBy("uid").transformWithState(
        NewestRatings(k), LISTS, "Update", "None", seed)


@contextmanager
def keyed_state(spark: SparkSession):
    """Settings of the state store for queries that start meanwhile: RocksDB,
    which uploads a batch's changes only."""
    before = {name: spark.conf.get(name, None) for name in (_PROVIDER, _CHANGELOG)}
    spark.conf.set(_PROVIDER, _ROCKSDB)
    spark.conf.set(_CHANGELOG, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


class RecentLists:
    """The lists of a running or finished stream; ``sink`` is keyed by uid."""

    def __init__(self, sink: KeyedLog, k: int = 20, compact_every: int | None = None):
        self.sink, self.k, self.compact_every = sink, k, compact_every

    def _write(self, lists: DataFrame, batch_id: int) -> None:
        self.sink.write_batch(lists, batch_id)
        if self.compact_every and batch_id > 0 and batch_id % self.compact_every == 0:
            self.sink.compact(lists.sparkSession)

    def start(self, messages: DataFrame, checkpoint: str, initial: DataFrame | None = None,
              available_now: bool = False, trigger_seconds: int = 2) -> StreamingQuery:
        """Keep the lists of the streaming ``messages``."""
        with keyed_state(messages.sparkSession):
            w = (newest_lists(messages, self.k, initial).writeStream.outputMode("update")
                 .foreachBatch(self._write).option("checkpointLocation", checkpoint))
            w = w.trigger(availableNow=True) if available_now else \
                w.trigger(processingTime=f"{trigger_seconds} seconds")
            return w.start()

    def read(self, spark: SparkSession) -> DataFrame:
        """(uid, pos, mid, score, timestamp) of all users seen by the stream."""
        return self.sink.current_rows(spark).select("uid", "pos", "mid", "score", "timestamp")


def stored_lists(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(uid, mid, score, timestamp) of every user's list, read from the state
    of the last committed batch of the stream at ``checkpoint``."""
    state = (spark.read.format("statestore").option("stateVarName", STATE)
             .option("flattenCollectionTypes", "true").load(checkpoint))
    return state.select(F.col("key.uid").alias("uid"), "list_element.*")
