"""Toxicity from subword-bag embeddings under a linear softmax.

A text is lower-cased, cut into words (runs of letters and digits) and each
word, with its borders marked, into character n-grams.  The n-grams are hashed
to rows of an embedding table; a document is the average of its rows, where
a word said c times weighs log(1 + c), so that one repeated endlessly doesn't
drown the others.  A linear softmax over that average gives the two classes.  Table and softmax
are trained jointly (Adam, numpy) on a bounded sample of labelled documents;
a misspelt word shares most n-grams, hence most of its vector, with the known
one.  As the softmax is linear, a trained model is one number per table row,
and scoring a text is an average of table look-ups.

Inputs: a null, empty or wordless text has the score of the prior alone; rows
that repeat a doc_id are scored one by one; without labelled rows of both
classes the score is the prior's; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import fold, id_text, labelled_sample, map_blocks, mix, shared

BUCKETS = 1 << 19
SIZES = (3, 4, 5, 6)
#: Weight of n-grams that say nothing, added to every text: one of few words isn't judged by chance.
NEUTRAL = 200.0
HELD_OUT = 1
FOLDS = 3


def words_of(text: str) -> Counter:
    return Counter(regex.findall(r"[\p{L}\p{M}\p{N}]+", text.lower()))


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts' distinct words, a space around each; the text
    of every code point; and the weight of the word that it belongs to (a
    border belongs to the word after it)."""
    bags = [words_of(t) for t in texts]
    flat = [w for bag in bags for w in bag]
    points = np.frombuffer((" " + " ".join(flat) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter(map(len, flat), np.int64, len(flat)) + 1
    owner = np.repeat(np.arange(len(texts)), [len(bag) for bag in bags])
    weight = np.log1p(np.array([n for bag in bags for n in bag.values()], dtype=np.float64))
    tail = [0] if len(flat) else []
    return points, np.append(np.repeat(owner, sizes), tail), np.append(np.repeat(weight, sizes), tail)


def grams(points: np.ndarray):
    """For each n-gram length: the starts that lie in one word, and their buckets."""
    n = len(points)
    wide = points.astype(np.uint64)
    key = np.zeros(n, np.uint64)
    before = np.zeros(n + 1, np.int64)       # spaces before
    np.cumsum(points == 32, out=before[1:])
    for size in range(1, max(SIZES) + 1):
        if size > n:
            return
        # the hash of size code points from that of size - 1
        key = key[:n - size + 1] * np.uint64(0x9E3779B97F4A7C15) + wide[size - 1:] + np.uint64(1)
        if size in SIZES:
            whole = np.flatnonzero(before[size - 1:n] == before[1:n - size + 2])
            yield whole, (mix(key[whole] + np.uint64(size)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, share of the average) pairs of each text."""
    points, owner, weight = codes(texts)
    found = list(grams(points))
    if not len(owner) or not found:
        return [(np.zeros(0, np.int64), np.zeros(0)) for _ in texts]
    key, slot = np.unique(np.concatenate([owner[at] * BUCKETS + b for at, b in found]), return_inverse=True)
    share = np.bincount(slot, weights=np.concatenate([weight[at] for at, _ in found]))
    cut = np.searchsorted(key, np.arange(len(texts) + 1) * BUCKETS)
    return [(key[a:b] % BUCKETS, share[a:b] / (share[a:b].sum() + NEUTRAL)) for a, b in zip(cut, cut[1:])]


def averages(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Average of the weights over each text's n-grams (0 if it has none)."""
    points, owner, weight = codes(texts)
    total, share = np.zeros(len(texts)), np.zeros(len(texts))
    for at, bucket in grams(points) if len(owner) else ():
        total += np.bincount(owner[at], weights=weight[at] * weights[bucket], minlength=len(texts))
        share += np.bincount(owner[at], weights=weight[at], minlength=len(texts))
    return total / (share + NEUTRAL)


@dataclass
class Model:
    weights: np.ndarray     # per bucket: log-odds of toxic that an n-gram adds to the average
    bias: float


def gradients(bag: np.ndarray, rows: np.ndarray, soft: np.ndarray, bias: np.ndarray, label: np.ndarray, cost: np.ndarray,
              decay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the weighted log-loss, and half ``decay`` times the squared weights,
    by the embedding rows, the softmax weights and the bias; ``bag`` has a
    document's shares of the rows."""
    mean = bag @ rows
    logit = mean @ soft + bias
    p = np.exp(logit - logit.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(label)), label] -= 1
    p = (p * cost[:, None]).astype(bag.dtype)
    return bag.T @ (p @ soft.T) + decay * rows, mean.T @ p + decay * soft, p.sum(axis=0)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], dim: int = 8, epochs: int = 8, batch: int = 32,
          rate: float = 0.02, decay: float = 3e-4, scale: float = 32.0, min_docs: int = 4, least_steps: int = 700, seed: int = 7) -> Model:
    """Embedding table and softmax from (buckets, shares, label) rows.

    Buckets of fewer than ``min_docs`` documents stay zero, like all that
    the sample lacks: what one document alone has says nothing of others."""
    labels = np.array([r[2] for r in rows])
    if len(set(labels.tolist())) < 2:
        p = labels.mean() if len(labels) else 0.5
        return Model(np.zeros(BUCKETS, np.float32), float(np.clip(np.log((p + 1e-3) / (1 - p + 1e-3)), -7, 7)))
    rng = np.random.default_rng(seed)
    seen = np.zeros(BUCKETS, np.int64)
    for bucket, _, _ in rows:
        seen[bucket] += 1
    rows = [(b[seen[b] >= min_docs], share[seen[b] >= min_docs], label) for b, share, label in rows]
    table = np.zeros((BUCKETS, dim), np.float32)
    soft = rng.normal(0, 0.3, (dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in (("table", table), ("soft", soft), ("bias", bias))}
    steps = 0
    epochs = max(epochs, -(-least_steps * batch // len(rows)))     # small samples go round more often
    total = epochs * -(-len(rows) // batch)
    pace = rate

    def adam(name, value, grad, at=slice(None)):
        m, v = state[name]
        m[at] = 0.9 * m[at] + 0.1 * grad
        v[at] = 0.99 * v[at] + 0.01 * grad * grad
        value[at] -= pace * (m[at] / (1 - 0.9 ** steps)) / (np.sqrt(v[at] / (1 - 0.99 ** steps)) + 1e-8)

    # toxic documents are the rarer ones; both classes weigh the same
    share = np.bincount(labels, minlength=2) / len(labels)
    cost = (0.5 / share)[labels]
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            steps += 1
            pace = rate * (1 - (steps - 1) / total)
            pick = order[at:at + batch]
            idx = np.concatenate([rows[i][0] for i in pick])
            own = np.repeat(np.arange(len(pick)), [len(rows[i][0]) for i in pick])
            share_of = np.concatenate([rows[i][1] for i in pick]).astype(np.float32) * np.float32(scale)
            used, slot = np.unique(idx, return_inverse=True)
            bag = np.zeros((len(pick), len(used)), np.float32)
            bag[own, slot] = share_of
            rowsv = table[used]
            by_row, by_soft, by_bias = gradients(bag, rowsv, soft, bias, labels[pick], cost[pick] / len(pick), decay)
            adam("table", table, by_row, used)
            adam("soft", soft, by_soft)
            adam("bias", bias, by_bias)
    return Model((scale * (table @ (soft[:, 1] - soft[:, 0]))).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1200, **options) -> Model:
    """A model from at most ``per_class`` labelled documents of each class,
    none of them from the held-out fold."""
    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = features(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"),
             pa.array([b.astype("<u4").tobytes() for b, _ in found], pa.binary()),
             pa.array([s.astype("<f4").tobytes() for _, s in found], pa.binary())],
            ["doc_id", "label", "buckets", "shares"])

    sample = labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, per_class)
    rows = map_blocks(sample, block, "doc_id long, label int, buckets binary, shares binary").collect()
    rows.sort(key=lambda r: r.doc_id)
    return train([(np.frombuffer(r.buckets, "<u4"), np.frombuffer(r.shares, "<f4"), r.label) for r in rows],
                 **options)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row: the softmax probability of toxic."""
    held = shared(docs.sparkSession, model)

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        odds = averages(batch.column("text").to_pylist(), held().weights) + held().bias
        score = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return map_blocks(id_text(docs), block, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, per_class: int = 1200) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    found = scores(docs, fit(docs, labels, per_class))
    return found.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))
