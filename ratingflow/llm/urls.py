"""URL verdicts from rules, and from character models where no rule fits.

Two variable-order Markov models give the probability of each character of a
URL after its last characters: one learned from all URLs that the rules allow,
one from all that they block.  The longest context seen ``least`` times counts,
blended down to shorter ones by Witten-Bell smoothing.  A URL's score is the
difference of its log-likelihoods by its length; the threshold is the one that
tells allowed from blocked URLs best, both weighing the same, among a fifth of
the rule-decided URLs that the models have not seen; then that fifth is counted,
too.

A model is a Spark table with one row for each context and for each context
with a character, named by 64-bit hashes; it grows with the input.  URLs are
scored in blocks: the distinct names of each block are joined with the table,
and what is found comes back to the block.

Inputs: a null URL, or one without ``://``, has an empty host and path, no
rule, and the verdict of the models (a null URL as an empty one); without
rule-decided URLs of both kinds all others are allowed; repeated rows and ids
are judged one by one; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import discard, map_blocks, mix, saved

ORDER = 6
LEAST = 3
CALIBRATION_FOLDS = 5
_LETTERS = 256                   # characters that any may follow: the uniform base
_BIN = 0.002
#: Bytes of URLs handled at once.
BLOCK = 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path``) that fits, or null; a rule fits its
    host and all subdomains, if the path starts with the rule's."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def contexts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Text of every character (the end counts as one), the texts' sizes, the
    number of every character's gram, which is itself and ``ORDER`` characters
    before it, and for each order the names of the distinct grams' contexts and
    of these with the character."""
    points = np.frombuffer("".join("\2" * ORDER + t.lower() + "\3" for t in texts).encode("utf-32-le", "surrogatepass"),
                           np.uint32).astype(np.uint64)
    size = np.array([len(t.lower()) + 1 for t in texts], dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), size)
    at = np.arange(len(text)) + ORDER * (text + 1)
    context = np.zeros(len(at), np.uint64)
    for order in range(1, ORDER + 1):
        context = further(context, points, at, order)
    _, first, gram = np.unique(named(context, points[at], ORDER)[1], return_index=True, return_inverse=True)
    at = at[first]
    out = []
    context = np.zeros(len(at), np.uint64)
    for order in range(ORDER + 1):
        if order:
            context = further(context, points, at, order)
        out.append(named(context, points[at], order))
    return text, size, gram, out


def further(context: np.ndarray, points: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The contexts with one character more, ``order`` places back."""
    return context + (points[at - order] + np.uint64(1)) * np.uint64(pow(int(_STEP), order, 1 << 64))


def named(context: np.ndarray, char: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    name = mix(context + np.uint64(order))
    return name, mix(name + char * _STEP)


def names(texts: list[str]) -> np.ndarray:
    """All names that the scores of these texts need, once."""
    return np.unique(np.concatenate([x for both in contexts(texts)[3] for x in both]))


def scores_of(texts: list[str], found: pa.Table) -> np.ndarray:
    """Scores of the texts; ``found`` has the rows of the model's table that
    ``names`` of them asks for, any number of times."""
    key = found.column("key").to_numpy().view(np.uint64)
    key, first = np.unique(key, return_index=True)
    value = {c: np.append(found.column(c).to_numpy()[first], 0).astype(np.float64) for c in ("n0", "n1", "kinds0", "kinds1")}

    def rows(name: np.ndarray) -> np.ndarray:
        at = np.searchsorted(key, name)
        return np.where(np.append(key, np.uint64(0))[at] == name, at, len(key)) if len(key) else at

    text, size, gram, cells = contexts(texts)
    cells = [(rows(context), rows(pair)) for context, pair in cells]
    ratio = np.zeros(len(cells[0][0]))
    for side, sign in ((1, 1.0), (0, -1.0)):
        p = np.full(len(ratio), 1 / _LETTERS)
        live = np.ones(len(ratio), bool)
        for order, (context, pair) in enumerate(cells):
            seen, kinds = value[f"n{side}"][context], value[f"kinds{side}"][context]
            # a longer context than one that is too rare is rarer still
            live &= seen >= (LEAST if order else 1)
            p = np.where(live, (value[f"n{side}"][pair] + kinds * p) / np.maximum(seen + kinds, 1), p)
        ratio += sign * np.log(p)
    return np.bincount(text, weights=ratio[gram], minlength=len(texts)) / size


@dataclass
class Model:
    """``counts`` has by ``key`` the classes' numbers (0 blocked, 1 allowed)
    ``n0`` and ``n1`` of a context or of a context with a character, and of
    contexts ``kinds0`` and ``kinds1``, the distinct characters after them."""

    counts: DataFrame
    threshold: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """The scores of a few texts."""
        asked = self.counts.sparkSession.createDataFrame([(k,) for k in names(texts).view(np.int64).tolist()], "key long")
        return scores_of(texts, self.counts.join(asked, "key").toArrow())


def pair_counts(labelled: DataFrame) -> DataFrame:
    """(context, pair, n0, n1) over all rows of (text, side)."""
    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        side = batch.column("side").to_numpy(zero_copy_only=False)
        text, _, gram, cells = contexts(batch.column("text").to_pylist())
        own = side[text]
        context, pair = (np.concatenate(x) for x in zip(*cells))
        pair, first, which = np.unique(pair, return_index=True, return_inverse=True)
        n = [np.bincount(which, np.tile(np.bincount(gram, own == s), ORDER + 1)).astype(np.int64) for s in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(context[first].view(np.int64)), pa.array(pair.view(np.int64)),
                                           *map(pa.array, n)], ["context", "pair", "n0", "n1"])

    return (map_blocks(labelled, block, "context long, pair long, n0 long, n1 long", block_bytes=2 * BLOCK)
            .groupBy("context", "pair").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))


def counts_of(pairs: DataFrame) -> DataFrame:
    """The models' counts from those of contexts with a character."""
    by_context = pairs.groupBy(F.col("context").alias("key")).agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"),
        F.count_if(F.col("n0") > 0).alias("kinds0"), F.count_if(F.col("n1") > 0).alias("kinds1"))
    none = F.lit(0).cast("long")
    by_pair = pairs.select(F.col("pair").alias("key"), "n0", "n1", none.alias("kinds0"), none.alias("kinds1"))
    return saved(by_context.union(by_pair), "url-counts")


def best_threshold(histogram: list[tuple[int, int, int]]) -> float:
    """The score that tells the sides best: (bin, side, number) of scores; of
    equally good ones the middle of the lowest run."""
    bins = sorted({b for b, _, _ in histogram})
    total = [max(1, sum(n for _, s, n in histogram if s == side)) for side in (0, 1)]
    share = {b: [0.0, 0.0] for b in bins}
    for b, side, n in histogram:
        share[b][side] += n / total[side]
    below, best, good = [0.0, 0.0], -1.0, []
    for b in [*bins, (bins[-1] + 1 if bins else 0)]:
        value = below[0] - below[1]         # blocked below less allowed below
        if value > best + 1e-12:
            best, good = value, [b]
        if b in share:
            below = [below[0] + share[b][0], below[1] + share[b][1]]
    # between the bin that ends the run below and the first bin above
    at = good[0] if good else 0
    under = [b for b in bins if b < at]
    return _BIN * ((at + under[-1] + 1) / 2 if under else at)


def fit(labelled: DataFrame) -> Model | None:
    """A model from all rows of (text, side), or None if one side has none."""
    sides = {r.side for r in labelled.groupBy("side").count().collect()}
    if sides != {0, 1}:
        return None
    held_out = F.crc32(F.col("text").cast("binary")) % F.lit(CALIBRATION_FOLDS) == 0
    learned, rest = (saved(pair_counts(labelled.where(part)), "url-pairs") for part in (~held_out, held_out))
    model = Model(counts_of(learned), 0.0)
    first = model.counts
    scored = score(labelled.where(held_out), model, ["side"])
    histogram = (scored.groupBy(F.floor(F.col("score") / _BIN).cast("int").alias("bin"), "side").count().collect())
    every = learned.union(rest).groupBy("context", "pair").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    every = saved(every, "url-pairs")
    model = Model(counts_of(every), best_threshold([(r["bin"], r["side"], r["count"]) for r in histogram]))
    discard(learned, rest, every, first)
    return model


def score(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``score`` of rows that have a column ``text``."""
    kinds = dict(rows.dtypes)
    columns = ", ".join(f"{c} {kinds[c]}" for c in keep)
    made = [0]

    def tag(batch: pa.RecordBatch) -> pa.RecordBatch:
        made[0] += 1
        own = np.full(batch.num_rows, (TaskContext.get().partitionId() << 32) + made[0])
        return pa.RecordBatch.from_arrays([pa.array(own), *batch.columns], ["block", *batch.schema.names])

    def ask(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, text = batch.column("block").to_numpy(), batch.column("text")
        keys = [(b, names(text.filter(pa.array(own == b)).to_pylist())) for b in np.unique(own)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([b for b, _ in keys], [len(k) for _, k in keys])),
             pa.array(np.concatenate([k for _, k in keys]).view(np.int64))], ["block", "key"])

    def answer(batch: pa.Table, found: pa.Table) -> pa.Table:
        out = scores_of(batch.column("text").to_pylist(), found)
        return pa.table([*(batch.column(c) for c in keep), pa.array(out)], [*keep, "score"])

    # written, as a row must be in the same block whenever it is read
    blocks = saved(map_blocks(rows.select("text", *keep), tag, f"block long, text string, {columns}", block_bytes=BLOCK),
                   "url-blocks")
    asked = map_blocks(blocks.select("block", "text"), ask, "block long, key long", block_bytes=BLOCK)
    # a URL has some hundred names: their table is far larger than Spark takes it
    # for, so it must not be broadcast
    found = asked.join(model.counts.hint("merge"), "key")
    return (blocks.groupBy("block").cogroup(found.groupBy("block"))
            .applyInArrow(answer, columns + ", score double"))


def judge(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of (page_id,
    url); ``rules`` maps ``host/path`` to allow or block; where a rule fits
    there is no score."""
    url = F.col("url").cast("string")
    rows = pages.select("page_id", F.coalesce(url, F.lit("")).alias("text"),
                        host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    ruled = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        ruled = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(ruled)
    rows = rows.withColumn("ruled", ruled)
    side = (F.col("ruled") == "allow").cast("int").alias("side")
    model = fit(rows.where("ruled is not null").select("text", side))
    if model is None:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"),
                           F.lit(None).cast("double").alias("score"))
    judged = ["page_id", "host", "path", "rule"]
    found = score(rows.where("ruled is null"), model, judged)
    by_model = F.when(F.col("score") >= model.threshold, "allow").otherwise("block")
    by_rule = rows.where("ruled is not null").select(*judged, F.col("ruled").alias("verdict"), F.lit(None).cast("double").alias("score"))
    return by_rule.union(found.select(*judged, by_model.alias("verdict"), "score"))
