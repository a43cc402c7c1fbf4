"""Resampling of documents towards a target text distribution.

Features are runs of 1 to ``order`` consecutive words, counted by their CRC-32
modulo ``buckets`` over all documents and over the target texts.  A document
weighs the mean log ratio of its features' buckets; with a Gumbel number from
its id's hash added, the best scores are a draw without replacement.

A document is scanned once for all its features: words are joined by one space
and the running CRC is stored at both ends of every word.  As the CRC is linear,
that of words i to j is crc(to the end of j) xor crc(to the start of i) shifted
by the bytes between, whatever comes before; so a block's documents follow each
other in one stream.

Inputs: A to Z are lower-cased, words are runs of a-z, 0-9 and all beyond
ASCII; a null or empty text has no word and weight 0; rows that repeat a
doc_id are documents of their own, ranked among each other by n_features; a
null doc_id is the smallest and hashed as an empty one; a target without any
word is uniform over the buckets; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import discard, id_text, map_blocks, saved, split_batch

#: Bytes of text scanned at once; longer documents go in slices.
SLICE = 1 << 19
_TO_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_NEAR = 128         # shifts below this many bytes have a table of their own


class Shift:
    """CRC registers moved on by zero bytes, which is linear over GF(2)."""

    def __init__(self):
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
        self.step = step
        tables = [np.arange(256, dtype=np.uint32)[None] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]]
        for _ in range(_NEAR):
            tables.append(self.byte(tables[-1]))
        self.near = np.stack(tables[:_NEAR])
        self.far = [tables[_NEAR]]      # by _NEAR bytes, and twice as many each

    def byte(self, crc: np.ndarray) -> np.ndarray:
        return self.step[crc & np.uint32(255)] ^ (crc >> np.uint32(8))

    def space(self, crc: np.ndarray) -> np.ndarray:
        """The CRCs of the same bytes with a space behind."""
        return ~self.byte(~crc ^ np.uint32(32))

    @staticmethod
    def _by(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = table[0][crc & np.uint32(255)]
        for k in (1, 2, 3):
            out = out ^ table[k][(crc >> np.uint32(8 * k)) & np.uint32(255)]
        return out

    def __call__(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        low = size % _NEAR
        out = self.near[low, 0, crc & np.uint32(255)]
        for k in (1, 2, 3):
            out = out ^ self.near[low, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
        rest, k = size // _NEAR, 0
        while rest.any():
            if k == len(self.far):
                self.far.append(self._by(self.far[-1], self.far[-1]))
            odd = (rest & 1) == 1
            out[odd] = self._by(self.far[k], out[odd])
            rest, k = rest >> 1, k + 1
        return out


def slices(texts: pa.Array) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """Documents and their words, about ``SLICE`` bytes at a time; a longer
    document comes in several slices."""
    docs, words, held = [], [], 0
    for i, text in enumerate(texts):
        data = (text.as_py() or "").encode().translate(_TO_WORD)
        at = 0
        while at < len(data):
            stop = at + SLICE
            if stop < len(data) and (cut := data.find(b" ", stop)) >= 0:
                part, at = data[at:cut], cut
            else:
                part, at = data[at:], len(data)
            docs.append(i)
            words.append(part.split())
            held += len(part)
            if held >= SLICE:
                yield docs, words
                docs, words, held = [], [], 0
    if docs:
        yield docs, words


def features(texts: pa.Array, order: int, shift: Shift) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document of each word, document of each feature, CRC of each feature)."""
    # of the words before the slice that a run may begin with: the documents,
    # the stored CRCs and places of their starts
    doc, start, at = np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    crc, place = 0, 0
    for docs, words in slices(texts):
        own = np.repeat(np.array(docs), [len(w) for w in words])
        if not len(own):
            continue
        flat = [w for part in words for w in part]
        sizes = np.fromiter(map(len, flat), np.int64, len(flat))
        before = crc
        ends = np.fromiter(accumulate(flat, lambda c, w: crc32(w, crc32(b" ", c)), initial=before), np.uint32, len(flat) + 1)
        crc = int(ends[-1])
        stop = place + np.cumsum(sizes + 1)
        place = int(stop[-1])
        tail = len(doc)
        doc, start, at = np.append(doc, own), np.append(start, shift.space(ends[:-1])), np.append(at, stop - sizes)
        who, what = [], []
        for n in range(1, order + 1):
            last = np.arange(len(own))          # of the run, in this slice
            first = last + tail - n + 1
            last = last[first >= 0]
            first = first[first >= 0]
            same = doc[first] == own[last]
            first, last = first[same], last[same]
            who.append(own[last])
            what.append(ends[last + 1] ^ shift(start[first], stop[last] - at[first]))
        yield own, np.concatenate(who), np.concatenate(what)
        keep = max(0, len(doc) - order + 1)
        doc, start, at = doc[keep:], start[keep:], at[keep:]


def bucket_counts(texts: DataFrame, order: int, buckets: int) -> np.ndarray:
    """Number of features in each bucket, over all rows of ``text``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, total = Shift(), np.zeros(buckets, np.int64)
        for batch in batches:
            for block in split_batch(batch, "text", SLICE):
                for _, _, crc in features(block.column("text"), order, shift):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    # at most a row a bucket, whatever the input
    for bucket, n in (texts.select("text").mapInArrow(count, "bucket long, n long")
                      .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1)(S + B)) / ((s + 1)(T + B)))) for each bucket."""
    b = len(source)
    s_all, t_all = float(source.sum() + b), float(target.sum() + b)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, order: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of (doc_id, text)."""
    held: list[Shift] = []

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Shift())
        n = batch.num_rows
        words, number, total = (np.zeros(n, np.int64) for _ in range(3))
        for own, who, crc in features(batch.column("text"), order, held[0]):
            words += np.bincount(own, minlength=n)
            number += np.bincount(who, minlength=n)
            np.add.at(total, who, gain[crc % np.uint32(len(gain))])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(words), pa.array(number), pa.array(total // np.maximum(number, 1))],
            ["doc_id", "n_words", "n_features", "weight"])

    return map_blocks(docs, block, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) of a number u between 0 and 1 from the id's hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296))).cast("long")


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with their place in the order, from 1, as ``rank``; no task
    holds more than a range of them."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a row number tells equal rows apart, so that they spread over ranges
    keys = [*order, F.col("rank")]
    rows = rows.withColumn("rank", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    rows = saved(rows.withColumn("rank", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("rank", 33)
    # a row a range: as many as shuffle partitions
    sizes = sorted(map(tuple, rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()))
    before = [(p, n - m) for (p, m), n in zip(sizes, accumulate(n for _, n in sizes))]
    before = rows.sparkSession.createDataFrame(before, "part long, before long")
    within = F.col("rank").bitwiseAND(F.lit((1 << 33) - 1))
    return (rows.join(F.broadcast(before), part == F.col("part"))
            .withColumn("rank", F.col("before") + within + 1).drop("part", "before"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, order: int = 2, buckets: int = 10000,
             min_words: int = 20, seed: int = 7) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of
    ``docs``; of those with at least ``min_words`` words, ``percent`` of a
    hundred are drawn and ranked from 1 (others: null).  ``target`` has the
    texts whose distribution is aimed at."""
    docs = id_text(docs)
    texts = target.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    gain = gains(bucket_counts(docs, order, buckets), bucket_counts(texts, order, buckets))
    scored = weigh(docs, gain, order)
    scored = saved(scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "importance")
    enough = F.col("n_words") >= min_words
    drawn = scored.where(enough).count() * percent // 100
    out = ranked(scored, enough.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features"))
    discard(scored)
    return out.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
