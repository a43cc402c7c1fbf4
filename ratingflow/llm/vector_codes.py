"""Product codes of vectors, assigned with fixed pivots (LAESA).

A vector is scaled to integers and cut into equal consecutive parts; every
part position has a codebook, improved by rounds of assigning and averaging
in whole numbers.  Each position has a few fixed pivots, entries of its first
codebook far from each other.  A part's distances to them are computed once
and written with it.  In each round only the distances between pivots and
entries are new: |d(part, pivot) - d(pivot, entry)| bounds the distance of part
and entry from below.  Entries are tried in the order of their bounds, by
exact integer distances, until the next bound is above the best one.

Inputs: rows whose vector is null or holds a null or non-finite component go.
So do rows whose vector has another length than that of the smallest vec_id
whose length is a positive multiple of ``parts``.  Scaled components beyond
+-2^27 count as that, so that every distance fits a long.  Rows that repeat a
vec_id are vectors of their own, in the order of their components; a null
vec_id is the largest; other columns but the label are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import discard, saved

#: Fixed pivots of a part position.
PIVOTS = 4
#: Largest magnitude of a scaled component.
LIMIT = 1 << 27
#: Rows whose bounds are held at once.
_ROWS = 4096


def scaled(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite numbers, within +-LIMIT."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors.astype(np.float64) * scale), -LIMIT, LIMIT).astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors, broadcast."""
    return ((a - b) ** 2).sum(-1)


def pivots_of(entries: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Up to ``n`` entries, the first and then always the one farthest from
    those chosen (ties: the lower index)."""
    chosen = [0]
    far = squared(entries, entries[0])
    while len(chosen) < min(n, len(entries)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squared(entries, entries[chosen[-1]]))
    return entries[chosen]


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``x`` its nearest entry (ties: the lower index), the
    squared distance, and the number of exact distances that it took.

    ``to_pivots`` has the rows' distances to the pivots, in single precision."""
    between = np.sqrt(squared(pivots[:, None], entries).astype(np.float64))
    far = to_pivots.astype(np.float64)
    bound = np.zeros((len(x), len(entries)))
    for p in range(len(pivots)):
        total = far[:, p, None] + between[p]
        # less what single precision may have rounded away
        np.maximum(bound, np.abs(far[:, p, None] - between[p]) - total * 2.0 ** -22, out=bound)
    bound *= bound
    order = np.argsort(bound, axis=1, kind="stable")
    least = np.take_along_axis(bound, order, 1)
    best = np.full(len(x), np.iinfo(np.int64).max)
    index = np.full(len(x), len(entries))
    live = np.arange(len(x))
    done = np.zeros(len(x), np.int64)
    for step in range(len(entries)):
        live = live[least[live, step] <= best[live]]
        if not len(live):
            break
        entry = order[live, step]
        d = squared(x[live], entries[entry])
        done[live] += 1
        wins = (d < best[live]) | ((d == best[live]) & (entry < index[live]))
        best[live[wins]], index[live[wins]] = d[wins], entry[wins]
    return index, best, done


class Codebooks:
    """``entries`` (parts, entries, components) of the current round, and the
    ``pivots`` of each part position, which stay."""

    def __init__(self, first: np.ndarray):
        self.entries = first
        self.pivots = [pivots_of(e) for e in first]

    def assign(self, batch: pa.RecordBatch) -> Iterator[tuple[slice, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, part, components, entry, squared distance, computed)."""
        parts, _, width = self.entries.shape
        n = batch.num_rows
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, parts, width).astype(np.int64)
        far = batch.column("far").flatten().to_numpy(zero_copy_only=False).reshape(n, parts, PIVOTS)
        for at in range(0, n, _ROWS):
            rows = slice(at, min(n, at + _ROWS))
            for part, (entries, pivots) in enumerate(zip(self.entries, self.pivots)):
                own = x[rows, part]
                yield rows, part, own, *nearest(own, far[rows, part, :len(pivots)], entries, pivots)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def kept(vectors: DataFrame, vector: str, parts: int, label: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that are coded."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(label).alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.where(F.col("vector").isNotNull() & finite & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector").alias("n")).first()
    return rows.where(F.size("vector") == (first.n if first else 0))


def measured(rows: DataFrame, books: Codebooks, scale: int) -> DataFrame:
    """(vec_id, label, x, far): scaled components, and each part's distances
    to its pivots."""
    parts, _, width = books.entries.shape

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = scaled(batch.column("vector").flatten().to_numpy(zero_copy_only=False), scale).reshape(n, parts, width)
            far = np.zeros((n, parts, PIVOTS), np.float32)
            for part, pivots in enumerate(books.pivots):
                far[:, part, :len(pivots)] = np.sqrt(squared(x[:, part, None], pivots).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), _lists(x.astype(np.int32), n), _lists(far, n)],
                ["vec_id", "label", "x", "far"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(block, f"vec_id long, label {kind}, x array<int>, far array<float>")


def _lists(values: np.ndarray, n: int) -> pa.Array:
    ends = np.arange(n + 1, dtype=np.int32) * (values.size // n if n else 0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def improved(data: DataFrame, books: Codebooks) -> np.ndarray:
    """The entries replaced by floor(sum / count) of the parts nearest to them;
    unused entries stay."""
    parts, k, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, k, width + 1), np.int64)
        for batch in batches:
            for _, part, x, entry, _, _ in books.assign(batch):
                np.add.at(total[part], entry, np.concatenate((x, np.ones((len(x), 1), np.int64)), axis=1))
        slot = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total.ravel()[slot])], ["slot", "n"])

    # a task gives a row for each number of the codebooks at most, and as many
    # come to the driver whatever the input
    found = data.mapInArrow(sums, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(parts * k * (width + 1), np.int64)
    for slot, n in found:
        total[slot] = n
    total = total.reshape(parts, k, width + 1)
    count = total[..., -1:]
    return np.where(count > 0, total[..., :-1] // np.maximum(count, 1), books.entries)


def encode(vectors: DataFrame, vector: str = "embedding", label: str = "label", parts: int = 16, entries: int = 64,
           rounds: int = 2, scale: int = 256) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256, computed) of
    every kept row: ``code`` has two hex digits for each part's entry, ``error``
    is the squared distance to the entries, ``label_error`` its sum over the
    rows with that label (null if beyond a long), ``computed`` the number of
    exact distances that the bounds left to compute, of parts * entries."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has two hex digits: 1 to 256 entries")
    rows = kept(vectors, vector, parts, label)
    kind = rows.schema["label"].dataType.simpleString()
    # the first codebook: at most ``entries`` rows
    first = [r.vector for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()]
    if not first:
        empty = f"vec_id long, label {kind}, code string, error long, label_error long, codebooks_sha256 string, computed long"
        return vectors.sparkSession.createDataFrame([], empty)
    start = scaled(np.array(first), scale).reshape(len(first), parts, -1).transpose(1, 0, 2)
    books = Codebooks(np.ascontiguousarray(start))
    data = saved(measured(rows, books, scale), "vector-parts")
    for _ in range(rounds):
        books.entries = improved(data, books)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            code = np.zeros((n, parts), np.uint8)
            error, computed = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for at, part, _, entry, d, done in books.assign(batch):
                code[at, part] = entry
                error[at] += d
                computed[at] += done
            text = code.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)], pa.string()),
                 pa.array(error), pa.array(computed)], ["vec_id", "label", "code", "error", "computed"])

    coded = saved(data.mapInArrow(codes, f"vec_id long, label {kind}, code string, error long, computed long"), "vector-codes")
    discard(data)
    # one row a label, written so that rows of a frequent label can be split
    totals = saved(coded.groupBy(F.col("label").alias("of")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")), "label-errors")
    return (coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).withColumn("codebooks_sha256", F.lit(books.sha256()))
            .select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256", "computed"))
