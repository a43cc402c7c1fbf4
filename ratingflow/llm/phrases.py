"""Document fingerprints by locally consistent parsing.

A text's symbols are grouped into phrases, the phrases are named, and the
names are grouped again, level by level.  Where a phrase ends depends on a few
neighbouring symbols only, by deterministic coin tossing: a symbol's label is
the lowest bit in which it differs from the symbol before, with that bit's
value; labels of labels shrink to fewer than six values, and phrases begin at
local maxima.  (Equal neighbours are first merged into one symbol with their
number.)  So equal substrings are cut alike except near their ends, wherever
they stand, and share the names of their inner phrases at every level.

A fingerprint is the ``size`` smallest hashes of the names at levels ``FIRST``
to ``LAST``, as hexadecimal digits in ascending order; likeness is the share
of the smallest hashes of two fingerprints' union that both have, an estimate
of the Jaccard likeness of their names (exact for short texts).

Inputs: a null text is empty and has an empty fingerprint; two empty
fingerprints are alike (1), an empty one and another are not (0); rows that
repeat a doc_id are ordered by a hash of their texts and kept one by one; null
ids come first; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import BLOCK_BYTES, id_text, map_blocks, mix

FIRST, LAST = 2, 4
SIZE = 64
#: 64-bit symbols have labels below 128, then 14, then 8, then 6.
ROUNDS = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.multiply.accumulate(np.full(64, _ODD, np.uint64))


def coin_labels(x: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Labels below six in which neighbours differ as the symbols do; ``heads``
    are the first symbols of the texts."""
    for _ in range(ROUNDS):
        one = x.dtype.type(1)
        diff = x[1:] ^ x[:-1]
        low = np.bitwise_count((diff & (~diff + one)) - one)
        low = np.concatenate((np.zeros(1, np.uint8), low))
        low[heads] = 0
        x = (low << np.uint8(1)) | ((x >> low.astype(x.dtype)) & one).astype(np.uint8)
    return x


def phrase_level(x: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of all texts, and the first phrase of each text."""
    n = len(x)
    # equal neighbours become one symbol
    new = np.ones(n, bool)
    new[1:] = x[1:] != x[:-1]
    new[heads] = True
    at = np.flatnonzero(new)
    if len(at) < n:
        run = np.diff(np.append(at, n)).astype(np.uint64)
        x = x[at].astype(np.uint64)
        x = np.where(run > 1, mix(x * _ODD + run), x)
        heads = np.searchsorted(at, heads)
        n = len(x)
    # phrases begin at local maxima and at the beginning of a text
    label = coin_labels(x, heads)
    is_head = np.zeros(n + 1, bool)
    is_head[heads] = True
    is_head[n] = True
    peak = np.zeros(n, bool)
    peak[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    peak &= ~is_head[1:]             # a text's last symbol starts no phrase
    peak |= is_head[:-1]
    starts = np.flatnonzero(peak)
    size = np.diff(np.append(starts, n))
    place = np.arange(n) - np.repeat(starts, size)
    wide = mix(x.astype(np.uint64))
    names = np.add.reduceat(wide * _POWERS[place & 63], starts)
    return mix(names + size.astype(np.uint64)), np.searchsorted(starts, heads)


def sketches(texts: list[str], size: int = SIZE) -> list[np.ndarray]:
    """The ``size`` smallest 32-bit hashes of each text's phrase names."""
    full = [i for i, t in enumerate(texts) if t]
    out = [np.zeros(0, np.uint32) for _ in texts]
    if not full:
        return out
    x = np.frombuffer("".join(texts[i] for i in full).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.array([len(texts[i]) for i in full])
    heads = np.cumsum(length) - length
    found = []
    for level in range(1, LAST + 1):
        x, heads = phrase_level(x, heads)
        if level >= FIRST:
            found.append((np.repeat(np.arange(len(full)), np.diff(np.append(heads, len(x)))),
                          (mix(x + np.uint64(level)) >> np.uint64(32)).astype(np.uint64)))
    owner, value = (np.concatenate(c) for c in zip(*found))
    # only the smaller hashes can count; where that leaves too few, all do
    count = np.bincount(owner, minlength=len(full))
    limit = np.minimum(2.0 ** 32, 2.0 ** 32 * 4 * size / np.maximum(count, 1)).astype(np.uint64)
    near = value <= limit[owner]
    key = np.unique((owner[near].astype(np.uint64) << np.uint64(32)) | value[near])
    cut = np.searchsorted(key, np.arange(len(full) + 1, dtype=np.uint64) << np.uint64(32))
    for k, i in enumerate(full):
        own = key[cut[k]:cut[k + 1]]
        if len(own) < size and limit[k] < 1 << 32:
            own = np.unique(value[owner == k])
        out[i] = (own[:size] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out


def to_hex(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard likeness of two sketches."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    ours, theirs = set(a.tolist()), set(b.tolist())
    union = sorted(ours | theirs)[:size]
    both = ours & theirs
    return sum(u in both for u in union) / len(union)


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = sketches(batch.column("text").to_pylist(), size)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([to_hex(s) for s in found])],
                                          ["doc_id", "fingerprint"])
    return map_blocks(id_text(docs), block, "doc_id long, fingerprint string")


_PLACE = np.dtype([("some", "i1"), ("doc_id", "i8"), ("hash", "i8")])
#: Sample points of a range: its bytes are even within about a tenth.
_POINTS = 100


def _places(doc_id: pd.Series, hash_: pd.Series) -> np.ndarray:
    """Rows as places in the order of documents: null ids, then by id, then hash."""
    out = np.zeros(len(doc_id), _PLACE)
    known = doc_id.notna().to_numpy()
    out["some"] = known
    out["doc_id"][known] = doc_id[known].to_numpy().astype(np.int64)
    out["hash"] = hash_.to_numpy()
    return out


def _borders(rows: DataFrame, ranges: int) -> np.ndarray:
    """Places that cut the documents in ``ranges`` of about equal bytes, from
    some ``_POINTS`` sample points a range, more for longer texts."""
    total = rows.agg(F.sum(F.col("n") + 1)).first()[0] or 0
    unit = max(1, total // (ranges * _POINTS))
    # a text of n bytes is n / unit points, the rest by chance of its own hash
    chance = F.pmod(F.xxhash64("hash", "row"), F.lit(unit))
    points = rows.select("doc_id", "hash", F.floor((F.col("n") + 1 + chance) / unit).alias("points")).where("points > 0")
    points = points.toPandas()
    if not len(points):
        return np.zeros(0, _PLACE)
    places = _places(points["doc_id"], points["hash"])
    order = np.argsort(places, order=_PLACE.names)
    ends = np.cumsum(points["points"].to_numpy()[order])
    return places[order][np.searchsorted(ends, ends[-1] * np.arange(1, ranges) / ranges, "left")]


def with_next_document(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(target, guest, doc_id, text) dealt out so that each document meets the
    one after it: rows of one ``target`` are a range of documents in order,
    then (as guest) the first row of the next range; the last range gets the
    first.  Rows with the same id and text may be dealt to several ranges."""
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = id_text(docs).select("doc_id", "text", F.xxhash64("text").alias("hash"), F.octet_length("text").alias("n"),
                                F.monotonically_increasing_id().alias("row"))
    borders = _borders(rows.drop("text"), ranges)

    @F.pandas_udf("int")
    def target(doc_id: pd.Series, hash_: pd.Series, row: pd.Series) -> pd.Series:
        place = _places(doc_id, hash_)
        low, high = np.searchsorted(borders, place, "left"), np.searchsorted(borders, place, "right")
        # what equals several borders fills all ranges between them
        some = mix(row.to_numpy().astype(np.uint64)) % np.maximum(high - low, 1).astype(np.uint64)
        return pd.Series((low + np.where(high > low, 1 + some.astype(np.int64), 0)).astype(np.int32))

    dealt = rows.select("doc_id", "text", "hash", target("doc_id", "hash", "row").alias("target"))
    # one row a range: its number and the place of its first document
    first = sorted((r.target, r.own) for r in dealt.groupBy("target").agg(F.min(F.struct("doc_id", "hash")).alias("own")).collect())
    if not first:
        return dealt.select("target", F.lit(0).alias("guest"), "doc_id", "text")
    table = [(n, first[i - 1][0], own.doc_id, own.hash) for i, (n, own) in enumerate(first)]
    table = F.broadcast(spark.createDataFrame(table, "target int, before int, first_id long, first_hash long"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("hash") == F.col("first_hash"))
    # one of the rows that are the first place of a range, as guest of the range before
    guests = (dealt.join(table, "target").where(is_first).groupBy("before")
              .agg(F.min(F.struct("hash", "doc_id", "text")).alias("g"))
              .select(F.col("before").alias("target"), F.lit(1).alias("guest"), "g.doc_id", "g.text", "g.hash"))
    own = dealt.select("target", F.lit(0).alias("guest"), "doc_id", "text", "hash")
    return (own.union(guests).repartitionById(ranges, F.col("target"))
            .sortWithinPartitions("target", "guest", "doc_id", "hash", "text").drop("hash"))


def edit(text: str, following: str) -> str:
    """The last half of the text replaced by the beginning of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edited_fingerprints(docs: DataFrame, size: int = SIZE, ranges: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) of every row; see ``edit``."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(rows: list[tuple]) -> pa.RecordBatch:
        """Rows in order; each but the last is compared with the one after."""
        texts = [r[3] for r in rows]
        edited = [edit(a, b) for a, b in zip(texts, texts[1:])]
        found = sketches(texts + edited, size)
        own, changed = found[:len(texts)], found[len(texts):]
        out = []
        for i, (row, text) in enumerate(zip(rows[:-1], edited)):
            if row[1] or row[0] != rows[i + 1][0]:      # a guest, or the last of a range
                continue
            out.append((row[2], len(row[3]), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
                        to_hex(own[i]), to_hex(changed[i]),
                        likeness(own[i], changed[i], size), likeness(own[i], own[i + 1], size)))
        columns = list(zip(*out)) if out else [()] * len(names)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("target", "guest", "doc_id", "text"))):
                rows.append(row)
                held += len(row[3])
                if held > BLOCK_BYTES // 2 and len(rows) > 1:
                    yield compare(rows)
                    rows, held = rows[-1:], len(row[3])
        if len(rows) > 1:
            yield compare(rows)

    return with_next_document(docs, ranges).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
             " near_edited double, near_next double")
