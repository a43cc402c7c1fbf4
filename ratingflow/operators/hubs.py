"""Equi join whose left side may hold very many rows of a few keys.

Adaptive execution splits a skewed partition at run time where both sides are
plain exchanges.  This join needs no such luck: heavy keys are found by
counting, and only they are salted on the left and copied on the right.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, key: str, tasks: int) -> list[tuple]:
    """(key, parts): keys that hold more than twice a task's fair share of the
    rows, most rows first, and how many shares that is; fewer than ``tasks`` / 2."""
    share = -(-df.where(F.col(key).isNotNull()).count() // tasks)
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * share)
    return [(r[0], -(-r.n // share)) for r in counts.orderBy(F.col("n").desc(), key).limit(tasks).collect()]


def hub_join(left: DataFrame, right: DataFrame, key: str, spread_by: str, tasks: int | None = None,
             counted: DataFrame | None = None) -> DataFrame:
    """``left.join(right, key)``, each heavy key's left rows dealt over several
    tasks by the hash of ``spread_by``.  The right rows of a heavy key are
    copied as often as it has parts, ``tasks`` + the number of such keys in all.
    ``counted``: a cheaper table with as many rows a key as ``left``."""
    spark = left.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # fewer rows than tasks
    found = heavy_keys(left if counted is None else counted, key, tasks)
    if not found:
        return left.join(right, key)
    heavy = spark.createDataFrame(found, f"{key} {dict(left.dtypes)[key]}, _salts int")
    salts = F.coalesce("_salts", F.lit(1))
    spread = left.join(F.broadcast(heavy), key, "left") \
        .withColumn("_salt", F.pmod(F.xxhash64(spread_by), salts).cast("int")).drop("_salts")
    copied = right.join(F.broadcast(heavy), key, "left") \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    # never broadcast on the size of compressed rows
    return spread.hint("merge").join(copied, [key, "_salt"]).drop("_salt")
