"""Rating stream -> per-user recommendation replace.

Every micro-batch of ``UID|MID|SCORE|TIMESTAMP`` messages goes through
``operators.recommend.rescore`` (latest message per user, recent ratings,
unseen similar candidates, scores) inside ``foreachBatch``, and the users'
rec rows are replaced in a ``KeyedLog``.

History: a ``UserHistory`` (point access: a batch opens its users' buckets
only), a table, or a function that reads a table anew for each batch.  With
``Params.append_history`` the stream's own messages join it, and a batch sees
them up to itself: they go to the same buckets of a ``UserHistory``, or to one
beside the sink.

Bad messages are dropped and counted in a table beside the sink, by batch
(``RescoreHandler.message_counts``).

Recovery: a batch writes its history, its recs and its counts, each under its
own ``batch_id``, and last of all a commit record (``KeyedLog.commit``), which
``committed`` readers wait for.  The streaming checkpoint records offsets; a
replayed batch recomputes the same rows and overwrites its own parts.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratingflow.functions.scalar import parse_message_fields, recs_to_string
from ratingflow.operators.recommend import ranked_edges, rescore
from ratingflow.operators.similarity import SimilarMovies
from ratingflow.params import Params
from ratingflow.sinks.history import EdgeTable, UserHistory
from ratingflow.sinks.tables import KeyedLog


def parse_messages(df: DataFrame, value_col: str = "value", strict: bool = False) -> DataFrame:
    """(uid, mid, score, timestamp) from message text; non-strict drops
    malformed rows instead of failing the batch."""
    parsed = df.select(*parse_message_fields(F.col(value_col).cast("string"), strict=strict))
    return parsed if strict else parsed.dropna()


class RescoreHandler:
    """``foreachBatch`` function: re-score the users of each batch."""

    COLUMNS = ("uid", "mid", "score", "timestamp")

    def __init__(self, history: UserHistory | DataFrame | Callable[[], DataFrame],
                 edges: EdgeTable | SimilarMovies | DataFrame,
                 sink: KeyedLog, params: Params = Params(), with_string: bool = False):
        """``history``: ratings with point access, a table, or a function that
        reads a table anew per batch.  ``edges``: with point access, or worked
        out per batch, or a table, which is then held whole."""
        self.history = history
        # the similarity table is a lookup (one value per movie pair, copies
        # collapse), ranked per movie and static: keep it across batches
        # (lineage is a table scan, so a lost block is simply re-read)
        self.edges = edges if isinstance(edges, (EdgeTable, SimilarMovies)) else \
            ranked_edges(edges, params.spread_hubs).persist(StorageLevel.MEMORY_AND_DISK)
        self.sink = sink
        self.own = history if isinstance(history, UserHistory) else \
            UserHistory(f"{sink.path}_history", params.history_buckets or 64)
        self.counts = KeyedLog(f"{sink.path}_counts", key="n", fmt=sink.fmt)
        self.params = params
        self.with_string = with_string

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        p = self.params
        spark = batch.sparkSession
        parsed = batch.select(*parse_message_fields(F.col("value").cast("string"), strict=False))
        ok = F.col("uid").isNotNull() & F.col("mid").isNotNull() & F.col("score").isNotNull() & F.col("timestamp").isNotNull()
        # counted in the pass that parses the messages, whichever job runs it
        counted = Observation(f"messages-{batch_id}")
        msgs = (parsed.observe(counted, F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_ok"))
                .where(ok).persist(StorageLevel.MEMORY_AND_DISK))
        held = [msgs]

        def hold(df: DataFrame) -> DataFrame:
            held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return df
        try:
            if p.append_history:
                self.own.append(msgs, batch_id)
            # the batch users' history is read once and reused for the
            # recent lists and the rated-movie exclusion
            mine = hold(self._history_for(msgs, batch_id))
            by_movie = isinstance(self.edges, (EdgeTable, SimilarMovies))
            recs = rescore(msgs, mine, None if by_movie else self.edges, hold=hold,
                           edges_of=self.edges.of_movies if by_movie else None,
                           pairs_of=self.edges.edges_of if isinstance(self.edges, SimilarMovies) else None, recent_k=p.recent_k,
                           cand_k=p.cand_k, threshold=p.score_threshold,
                           like_above=p.like_above, own_history=True, spread=p.spread_hubs)
            if self.with_string:
                recs = recs.withColumn("recs_string", recs_to_string("recs"))
            self.sink.write_batch(recs, batch_id)
            self.counts.write_batch(spark.createDataFrame([self._numbers(counted, parsed)], "n long, n_bad long"), batch_id)
            self.sink.commit(spark, batch_id)
            if p.compact_every and batch_id > 0 and batch_id % p.compact_every == 0:
                self.sink.compact(spark)
                if p.append_history:
                    self.own.compact(spark, batch_id)
        finally:
            for df in held:
                df.unpersist()

    @staticmethod
    def _numbers(counted: Observation, parsed: DataFrame) -> tuple[int, int]:
        """Messages, and bad ones among them."""
        try:
            seen = counted.get
        except Py4JJavaError:
            # without a good message Spark drops the observed step from the plan
            n = parsed.count()
            return n, n
        return seen["n"], seen["n"] - seen["n_ok"]

    def _history_for(self, msgs: DataFrame, batch_id: int | None = None) -> DataFrame:
        """The ratings of the batch's users, this batch's included."""
        users = msgs.select("uid").distinct()
        if isinstance(self.history, UserHistory):
            return self.history.of_users(users, batch_id)
        base = self.history() if callable(self.history) else self.history
        base = base.select(*self.COLUMNS).join(users, "uid", "left_semi")
        if self.params.append_history and batch_id is not None:
            base = base.unionByName(self.own.of_users(users, batch_id))
        return base

    def message_counts(self, spark: SparkSession) -> DataFrame:
        """(batch_id, n, n_bad) of the batches that ran, restarts included."""
        return self.counts.read_log(spark).select("batch_id", "n", "n_bad")

    def close(self) -> None:
        if not isinstance(self.edges, (EdgeTable, SimilarMovies)):
            self.edges.unpersist()


def start_rescoring(spark: SparkSession, source: DataFrame, handler: RescoreHandler,
                    checkpoint: str, available_now: bool = False,
                    trigger_seconds: int = 2) -> StreamingQuery:
    """Run ``handler`` on every micro-batch of ``source`` (a streaming
    DataFrame with a ``value`` column, e.g. the Kafka topic)."""
    w = source.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
