"""Typed table scans with an injected storage format.

The reference reads its tables from a document store; here the format and
its options are parameters (parquet by default), and the result is cut to
the contract schema so downstream plans only see the columns they need
(Catalyst prunes the rest at the scan).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str | None = None, schema: T.StructType | None = None,
               fmt: str = "parquet", options: dict | None = None, **more) -> DataFrame:
    """Scan a table and project/cast it to ``schema`` (if given);
    ``options`` go to the data source."""
    reader = spark.read.format(fmt).options(**{**(options or {}), **more})
    df = reader.load(path) if path is not None else reader.load()
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return df


def genre_table(spark: SparkSession, genres: Iterable[str]) -> DataFrame:
    """The genre list as a one-column DataFrame (size fixed by the caller's
    parameter, so it is safe to broadcast).  Built from literals, so it is
    planned JVM-side (no Python round trip)."""
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(str(g)) for g in genres])).alias("genre"))


def to_edges(nested: DataFrame, key: str = "mid") -> DataFrame:
    """(key, recs array<struct<rid,r>>) -> (key, rid, r) edge rows."""
    return nested.select(key, F.inline("recs")).select(key, "rid", "r")
