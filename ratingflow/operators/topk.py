"""Top-k per group and nesting helpers.

``row_number() <= k`` over a window is planned by Catalyst as a
WindowGroupLimit with a *partial* step before the shuffle, so each map task
forwards at most k rows per group: a hot group (say a third of all rows)
costs k rows per task on the wire, not its full size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int,
          pos: str = "pos") -> DataFrame:
    """Keep the first ``k`` rows of each ``by`` group in ``order``; add the
    1-based position ``pos`` (INT).  ``order`` must end in a unique
    tie-break so the result is deterministic."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(pos, F.row_number().over(w)).where(F.col(pos) <= k)


def nest(df: DataFrame, by: Sequence[str], pos: str, fields: Sequence[str],
         out: str = "recs") -> DataFrame:
    """Collect rows of each group into ``out: array<struct<fields>>`` in
    ``pos`` order.  Groups are bounded by a preceding top_k."""
    items = F.array_sort(F.collect_list(F.struct(F.col(pos), *[F.col(f) for f in fields])))
    return df.groupBy(*by).agg(
        F.transform(items, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(out))


def collect_sorted(df: DataFrame, by: Sequence[str], keys: Sequence[tuple[str, bool]],
                   fields: Sequence[str], out: str = "recs") -> DataFrame:
    """Collect each group into ``out: array<struct<fields>>`` sorted by
    ``keys`` = [(column, descending), ...] (numeric sort keys).

    A plain aggregate (partial collect, final merge + sort), for lists that
    are the output itself (e.g. every similar movie of a movie)."""
    kcols = [(-F.col(c) if desc else F.col(c)).alias(f"_k{i}") for i, (c, desc) in enumerate(keys)]
    items = F.array_sort(F.collect_list(F.struct(*kcols, *[F.col(f) for f in fields])))
    return df.groupBy(*by).agg(
        F.transform(items, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(out))
