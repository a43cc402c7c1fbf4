"""SimHash near-duplicate groups from deletion-variant signatures.

A 64-bit fingerprint is cut into ``bits // 2 + 1`` segments.  Two fingerprints
that differ in at most ``bits`` places have a segment in which they differ in
at most one.  Each segment is indexed as it stands and once with each of its
bits replaced by a wildcard; an equality join on these variants finds every
such pair, and the whole fingerprints then verify it.

Copies share one fingerprint, so the index holds distinct fingerprints.  A
bucket yields a spanning forest of its verified links, not all pairs; a bucket
of more than ``bucket_rows`` fingerprints is dealt out as pairs of blocks.

Inputs: null or empty texts have fingerprint zero and are linked like others;
rows repeating a doc_id or a text each get their row; a null doc_id never
names a group unless all its members have none (it is then null); other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import ROW, discard, id_text, map_blocks, saved, set_aside, with_row_keys

SEED = 42
BITS = 64
_LANES = np.uint64(0x0101010101010101)


def fingerprint_of(text: str, words: int) -> int:
    """Majority bits of the XXH64 of all ``words``-word shingles."""
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    width = min(words, len(tokens))
    starts = starts[:len(tokens) - width + 1].tolist()
    ends = ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    total = len(starts)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, total, 1 << 16):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)])]
        ones += bit_counts(np.array(part, dtype=np.uint64))
    bits = np.flatnonzero(ones * 2 > total)
    return sum(1 << int(b) for b in bits)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set.

    Eight bits are counted at once, one in each byte of a word; 255 rows at
    most fit such a counter."""
    out = np.zeros((8, 8), np.int64)
    edges = np.arange(0, len(hashes), 255)
    for low in range(8):
        lanes = (hashes >> np.uint64(low)) & _LANES
        sums = np.add.reduceat(lanes, edges)
        out[:, low] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.reshape(-1)


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp long) of every row."""
    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint_of(t, words) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
    return map_blocks(id_text(docs), block, "doc_id long, fp long")


def segments(bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ``bits // 2 + 1`` segments."""
    n = bits // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def forms(bits: int) -> list[tuple[int, int]]:
    """(mask, wildcard) of each form of a fingerprint: a segment as it stands
    (wildcard 0), or but for one of its bits."""
    out = []
    for first, width in segments(bits):
        whole = ((1 << width) - 1) << first
        out += [(whole, 0)] + [(whole & ~(1 << b), 1 << b) for b in range(first, first + width)]
    return out


def variants(fps: DataFrame, bits: int) -> DataFrame:
    """(tag, part, side, fp): the forms of each fingerprint, ``tag`` their
    numbers.  ``side`` is the wildcard's bit: only pairs from both sides are
    new there, as equal segments meet in the exact form already."""
    signed = [[v - (1 << 64) if v >> 63 else v for v in column] for column in zip(*forms(bits))]
    mask, wild = (F.array(*[F.lit(v).cast("long") for v in column]) for column in signed)
    # each fingerprint becomes some dozens of rows: spread them first, as few
    # bytes would else be few tasks
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = fps.repartition(tasks).select(
        "fp", F.explode(F.sequence(F.lit(0), F.lit(len(signed[0]) - 1))).alias("tag"))
    own = lambda column: F.col("fp").bitwiseAND(F.element_at(column, F.col("tag") + 1))
    return rows.select("tag", own(mask).alias("part"), (own(wild) != 0).cast("int").alias("side"), "fp")


def forest(fps: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Verified links that connect what is connected within these rows."""
    out = []
    left = fps
    while len(left) > 1:
        queue, left = [left[:1]], left[1:]
        while queue and len(left):
            for x in queue.pop():
                near = np.bitwise_count(left ^ x) <= bits
                if near.any():
                    hit = left[near]
                    out.append((np.full(len(hit), x, np.uint64), hit))
                    queue.append(hit)
                    left = left[~near]
                    if not len(left):
                        break
    return out


def links(fps: DataFrame, bits: int = 4, bucket_rows: int = 1 << 15, pair_rows: int = 16) -> DataFrame:
    """(a, b): links of at most ``bits`` differing bits between the distinct
    fingerprints of column ``fp``, enough of them to connect every group."""
    index = variants(fps.select("fp").distinct(), bits)
    exact = [tag for tag, (_, wild) in enumerate(forms(bits)) if not wild]

    # buckets that are too large for one task become pairs of blocks
    sizes = (index.groupBy("tag", "part").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > bucket_rows)
             .select("tag", "part", F.ceil(F.col("n") / bucket_rows).cast("int").alias("blocks")))
    sizes = saved(sizes, "simhash-large-buckets")
    if not sizes.isEmpty():
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                            lambda other: F.least(own, other) * F.col("blocks") + F.greatest(own, other))
        index = index.join(sizes, ["tag", "part"], "left").select(
            "tag", "part", "side", "fp",
            F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("cell"))
    else:
        index = index.withColumn("cell", F.lit(0))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("tag", "part", "cell", "side", "fp")]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            new = np.flatnonzero(np.any([x[1:] != x[:-1] for x in cols[:3]], axis=0)) + 1
            cut = new[-1] if len(new) else 0
            rest = [x[cut:] for x in cols]     # the last bucket may go on in the next batch
            yield from linked([x[:cut] for x in cols], new[:-1])
        if rest is not None:
            new = np.flatnonzero(np.any([x[1:] != x[:-1] for x in rest[:3]], axis=0)) + 1
            yield from linked(rest, new)

    def linked(cols: list[np.ndarray], new: np.ndarray) -> Iterator[pa.RecordBatch]:
        tag, side, fp = cols[0], cols[3], cols[4].view(np.uint64)
        if len(fp) < 2:
            return
        starts = np.concatenate(([0], new))
        ends = np.concatenate((new, [len(fp)]))
        size = ends - starts
        ones = np.add.reduceat(side.astype(np.int64), starts)
        live = (size > 1) & (np.isin(tag[starts], exact) | ((ones > 0) & (ones < size)))
        found = []
        small = live & (size <= pair_rows)
        pick = np.repeat(small, size)
        f, group = fp[pick], np.repeat(np.arange(len(starts)), size)[pick]
        for step in range(1, pair_rows):
            if len(f) <= step:
                break
            near = (group[step:] == group[:-step]) & (np.bitwise_count(f[step:] ^ f[:-step]) <= bits)
            if near.any():
                found.append((f[:-step][near], f[step:][near]))
        for i in np.flatnonzero(live & ~small):
            found += forest(fp[starts[i]:ends[i]], bits)
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return (index.repartition("tag", "part", "cell").sortWithinPartitions("tag", "part", "cell")
            .mapInArrow(verify, "a long, b long")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where("a < b").distinct())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the links (a < b), root the smallest node
    reachable: alternating large-star and small-star steps until no link moves."""
    def measure(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    edges = saved(edges, "links")
    seen = measure(edges)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("m").alias("a"), "b").where("a < b").distinct())
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select("m", "a", "b")
        before, edges = edges, saved(small.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
                                     .where("a < b").distinct(), "links")
        discard(before)
        now = measure(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("the groups did not settle; raise rounds")
    own = edges.select("a").distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        own.select(F.col("a").alias("node"), F.col("a").alias("root")))


def near_duplicates(docs: DataFrame, words: int = 4, bits: int = 4, bucket_rows: int = 1 << 15) -> DataFrame:
    """(doc_id, fp, component_id) of every row: component_id is the smallest
    doc_id that links of at most ``bits`` differing bits reach."""
    marked = saved(fingerprints(docs, words), "fingerprints")
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(first, bits, bucket_rows))
    named = (first.join(roots, F.col("fp") == F.col("node"), "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "first_id"))
    # written tables, so that both sides of the joins are plain exchanges and
    # Spark can split a group's rows over tasks, however many they are
    named = saved(named, "fingerprint-roots")
    least = saved(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "groups")
    ids = saved(named.join(least, "root").select("fp", "component_id"), "fingerprint-groups")
    discard(named, least)
    return marked.join(ids, "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, words: int = 4, bits: int = 4) -> DataFrame:
    """The rows of ``docs``, unchanged, that stand for their near-duplicate
    group: the one with the smallest doc_id, of equal ids that with the
    smallest text; a null doc_id comes last."""
    names = docs.columns
    docs, columns = set_aside(docs)
    keyed = with_row_keys(docs, null_last=True)
    groups = near_duplicates(keyed.withColumn("doc_id", F.col(ROW)), words, bits)
    drop = groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__drop"))
    return keyed.join(drop, F.col(ROW).eqNullSafe(F.col("__drop")), "left_anti").select(*columns).toDF(*names)
