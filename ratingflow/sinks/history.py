"""Ratings by user with point access, which a stream reads and extends, and
similarity edges by movie.

Layout of ``UserHistory``: ``{path}/base=<n>/ub=<bucket>`` is the table with all
batches up to n (-1: as loaded), ``{path}/log/batch_id=<n>/ub=<bucket>`` what
batch n added, in the same buckets.  A base counts once its job has committed
(``_SUCCESS``), so a ``compact`` that dies leaves the one before in place.  A
replayed batch overwrites its own folder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingflow.operators.runs import PackedEdges, nest_runs
from ratingflow.session import children, remove
from ratingflow.sinks.point import PointFiles, bucket_of

COLUMNS = {"uid": "int", "mid": "int", "score": "double", "timestamp": "int"}
EDGES = {"mid": "int", "page": "int", "rid": "array<int>", "r": "array<double>"}
PAGE_EDGES = 512        # edges of a row of the table of edges (6 KB)


class UserHistory:
    """See ``PointFiles`` for the parameters; a key is a user."""

    def __init__(self, path: str, buckets: int = 1024, row_group_bytes: int = 1 << 20, max_users: int = 1000):
        self.path = path.rstrip("/")
        self.files = PointFiles("uid", COLUMNS, buckets, row_group_bytes, max_users)

    def load(self, ratings: DataFrame) -> None:
        """Start anew from a table of ratings."""
        remove(ratings.sparkSession, self.path)
        self.files.write(ratings, f"{self.path}/base=-1")

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch's ratings; the same batch again replaces them."""
        self.files.write(rows, f"{self.path}/log/batch_id={int(batch_id)}")

    def _numbers(self, spark: SparkSession, folder: str, name: str) -> list[int]:
        found = (re.fullmatch(f"{name}=(-?[0-9]+)", x) for x in children(spark, folder))
        return sorted(int(m.group(1)) for m in found if m)

    def _bases(self, spark: SparkSession) -> list[int]:
        return [n for n in self._numbers(spark, self.path, "base")
                if "_SUCCESS" in children(spark, f"{self.path}/base={n}")]

    def _batches(self, spark: SparkSession) -> list[int]:
        return self._numbers(spark, f"{self.path}/log", "batch_id")

    def rows(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """(uid, mid, score, timestamp, ub): the ratings with all batches up to
        ``upto`` (default: all)."""
        bases = [n for n in self._bases(spark) if upto is None or n <= upto]
        base = bases[-1] if bases else None
        batches = [n for n in self._batches(spark) if (base is None or n > base) and (upto is None or n <= upto)]
        read = spark.read.schema(self.files.schema)
        parts = [read.parquet(f"{self.path}/base={base}")] if base is not None else []
        if batches:
            log = f"{self.path}/log"
            added = read.option("basePath", log).parquet(*(f"{log}/batch_id={n}" for n in batches))
            parts.append(added.drop("batch_id"))
        if not parts:
            return spark.createDataFrame([], self.files.schema)
        return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]

    def of_users(self, users: DataFrame, upto: int | None = None) -> DataFrame:
        """(uid, mid, score, timestamp) of the users in ``users`` (uid)."""
        return self.files.of_keys(self.rows(users.sparkSession, upto), users)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold all batches up to ``upto`` into a new base.  The base before
        stays, with the batches after it, for readers that hold it."""
        before = self._bases(spark)
        if before and before[-1] >= upto:
            return
        self.files.write(self.rows(spark, upto), f"{self.path}/base={int(upto)}")
        for n in before[:-1]:
            remove(spark, f"{self.path}/base={n}")
        for n in self._batches(spark):
            if before and n <= before[-1]:
                remove(spark, f"{self.path}/log/batch_id={n}")


class EdgeTable:
    """Similarity edges by movie, ranked and written once; a batch reads those
    of its movies.  A row is a page of a movie's edges, whose places follow from
    the page's number.  See ``PointFiles`` for the parameters."""

    def __init__(self, path: str, buckets: int = 1024, row_group_bytes: int = 1 << 20, max_movies: int = 10_000):
        self.path = path.rstrip("/")
        self.files = PointFiles("mid", EDGES, buckets, row_group_bytes, max_movies)

    def load(self, edges: DataFrame | PackedEdges) -> None:
        """Replace the table by ``edges`` (mid, rid, r): of copies of a pair the
        largest ``r`` counts.  Packed ones are shuffled once, to their buckets."""
        from ratingflow.operators.similarity import nest_edges
        if isinstance(edges, PackedEdges):
            pages = nest_runs(edges, PAGE_EDGES, bucket_of("mid", self.files.buckets), self.files.buckets)
        else:
            pages = nest_edges(edges.groupBy("mid", "rid").agg(F.max("r").alias("r")), page_rows=PAGE_EDGES)
        rows = pages.select("mid", "page", F.col("recs.rid").alias("rid"), F.col("recs.r").alias("r"))
        self.files.write(rows, self.path, dealt=isinstance(edges, PackedEdges))

    def of_movies(self, movies: DataFrame) -> DataFrame:
        """(mid, rid, r, pos) of the movies in ``movies`` (mid)."""
        pages = self.files.of_keys(movies.sparkSession.read.schema(self.files.schema).parquet(self.path), movies)
        one = pages.select("mid", "page", F.posexplode(F.arrays_zip("rid", "r")).alias("_at", "e"))
        return one.select("mid", "e.rid", "e.r", (F.col("page") * PAGE_EDGES + F.col("_at") + 1).alias("pos"))
