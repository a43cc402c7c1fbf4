"""Tables with point access by an integer key.

``PointFiles`` buckets rows by a hash of the key.  Inside a bucket the files
are sorted by key and carry Parquet bloom filters on it, so a read of a few keys
opens their buckets only, and of these only the row groups that the keys may be
in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "ub"
#: keys a scan is given: Parquet's reader takes them as nested ORs, one call deep a
#: key, and runs out of stack at some thousands
KEYS_A_SCAN = 500


def bucket_of(key: str, n_buckets: int) -> Column:
    """Hash bucket of a key (the partition column)."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(int(n_buckets))).cast("int")


class PointFiles:
    """``buckets`` should follow the cluster (a bucket is a file or a few);
    ``row_group_bytes`` bounds what one key's read decodes; up to ``max_keys``
    keys are pushed into scans of a few hundred each, beyond it a semi join finds them within
    their buckets."""

    def __init__(self, key: str, columns: dict[str, str], buckets: int, row_group_bytes: int, max_keys: int):
        self.key, self.columns, self.buckets = key, columns, buckets
        self.row_group_bytes, self.max_keys = row_group_bytes, max_keys
        self.schema = ", ".join(f"{c} {t}" for c, t in columns.items()) + f", {BUCKET} int"

    def write(self, rows: DataFrame, path: str, dealt: bool = False) -> None:
        """``dealt``: a partition holds rows of one bucket or a few already."""
        rows = rows.select(*(F.col(c).cast(t).alias(c) for c, t in self.columns.items()))
        rows = rows.withColumn(BUCKET, bucket_of(self.key, self.buckets))
        # the hint splits a bucket that holds a hot key over several tasks
        ((rows if dealt else rows.hint("rebalance", BUCKET)).sortWithinPartitions(BUCKET, self.key).write.mode("overwrite")
         .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
         .option("parquet.block.size", self.row_group_bytes)
         .partitionBy(BUCKET).parquet(path))

    def of_keys(self, rows: DataFrame, keys: DataFrame) -> DataFrame:
        """The rows (as written, with their buckets) of the keys in ``keys``."""
        spark = keys.sparkSession
        keys = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        keyed = keys.select(self.key, bucket_of(self.key, self.buckets).alias(BUCKET))
        few = keyed.limit(self.max_keys + 1).collect()
        if not few:
            return rows.where(F.lit(False)).select(*self.columns)
        if len(few) <= self.max_keys:
            # keys as literals: the scan skips row groups by statistics and bloom
            # filters, which needs the list to be pushed as it is
            spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(KEYS_A_SCAN))
            few = sorted((r[1], r[0]) for r in few)
            scans = []
            for at in range(0, len(few), KEYS_A_SCAN):
                part = few[at:at + KEYS_A_SCAN]
                mine = F.col(BUCKET).isin(sorted({b for b, _ in part})) & F.col(self.key).isin(sorted(k for _, k in part))
                scans.append(rows.where(mine).select(*self.columns))
            return reduce(lambda a, b: a.unionByName(b), scans)
        # a bounded list, whatever the keys
        buckets = sorted(r[0] for r in keyed.select(BUCKET).distinct().collect())
        return rows.where(F.col(BUCKET).isin(buckets)).select(*self.columns).join(keys, self.key, "left_semi")
