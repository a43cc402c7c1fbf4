"""Helpers shared by the text operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingflow.session import remove_scratch, scratch_path

#: Text bytes that one call of a block function sees at most (one document
#: may exceed it; the functions cut such a document into slices themselves).
BLOCK_BYTES = 1 << 19


#: Spark then drops a query's shuffle files when it ends, not when the driver
#: happens to collect its garbage; large steps follow each other here.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table to the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor only repeats the current step, and
    a table that several steps read is made once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete ``saved`` tables that no later step reads."""
    for table_ in tables:
        remove_scratch(table_.sparkSession, table_._saved_at)


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A function that gives ``value`` in any task.  It travels as a broadcast
    of bytes, classes by value, so executors need not have this package."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    loaded: list = []

    def get() -> Any:
        if not loaded:
            loaded.append(pickle.loads(held.value))
        return loaded[0]
    return get


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string); a null text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


#: The column that tells rows apart, and other columns that helpers add.
ROW = "__row"
_HELPERS = (ROW, "__spans", "__doc", "__drop")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` without columns of a helper's name, which are renamed, and the
    names of its columns now; ``toDF`` with the old ones undoes it."""
    out = docs
    for c in docs.columns:
        if c.lower() in _HELPERS:
            out = out.withColumnRenamed(c, free_name(out, f"{c}_input"))
    return out, out.columns


def with_row_keys(docs: DataFrame, null_last: bool = False) -> DataFrame:
    """``docs`` with a column ``ROW``, a long that no two rows share and that
    grows with doc_id (null the smallest, or the largest), then text.

    It is the doc_id itself unless some id, or null, repeats."""
    own = F.col("doc_id").cast("long")
    ids = docs.groupBy(own.alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1").isEmpty():
        return docs.withColumn(ROW, own)
    # a row number spreads the rows of one id and text over the ranges; the
    # written table then keeps each row's place in the order
    order = [own.asc_nulls_last() if null_last else own.asc_nulls_first(),
             F.coalesce(F.col("text").cast("string"), F.lit("")), F.col(ROW)]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.withColumn(ROW, F.monotonically_increasing_id())
    rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return saved(rows.withColumn(ROW, F.monotonically_increasing_id()), "keyed-rows")


def fold(modulus: int, key: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``modulus``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def map_blocks(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
               text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``mapInArrow`` whose function sees blocks of bounded text size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in split_batch(batch, text, block_bytes):
                out = fn(block)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def split_batch(batch: pa.RecordBatch, text: str, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``block_bytes`` of text, or one row."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0)
                       .to_numpy(zero_copy_only=False), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + block_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, end to end, and the n+1 offsets."""
    column = pc.fill_null(column.cast(pa.string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (the SplitMix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int,
                    per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents of each class.

    Rows whose fold is ``held_out`` are never taken, nor documents whose
    labels are null or contradict each other; among the others the hash of
    the id decides, so that a sample doesn't depend on row order."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold(modulus) != held_out))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("most"))
             .where("label = most").drop("most"))
    order = F.xxhash64("doc_id")
    pick = known.where("label = 0").orderBy(order).limit(per_class).union(
        known.where("label = 1").orderBy(order).limit(per_class))
    # at most 2 * per_class ids: small whatever the input
    return id_text(docs).join(F.broadcast(pick), "doc_id").dropDuplicates(["doc_id"])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file on the driver; the operators take paths
    and send the contents along, executors need no such file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def small_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a side table that must stay small; raises beyond ``limit``."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows; raise the limit only if they fit in memory")
    return rows
