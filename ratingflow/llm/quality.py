"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  Its features are shares of character classes,
repetition and word shape, in bins, of the line itself and of the lines before
and after it; a weight for each pair of neighbouring labels ties the line to
its neighbours.  Only documents are labelled, so the line labels are learned
in two steps: a classifier of single lines under their document's label, which
then says which lines of a bad document are bad, and the random field fitted
to those label sequences.  Forward and backward passes give each line's
probability of being good; their mean, weighted by the lines' lengths, is put
on the scale of the document labels by a logistic curve.

The fit uses at most ``per_class`` labelled documents of each class; scoring
takes whole texts.

Inputs: a null text is empty, and an empty text is one empty line, scored like
any other; rows that repeat a doc_id are scored one by one; without labelled
rows of both classes every score is that class's share (one half if there are
none); other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import fold, id_text, labelled_sample, map_blocks, shared, text_bytes
from ratingflow.llm.substring_dedup import PIECE, word_bounds, word_names
from ratingflow.llm.windows import Names

HELD_OUT = 1
FOLDS = 3

#: Upper edges of the bins of each feature; the last bin is open.
BINS = {
    "upper": (0.0, 0.04, 0.1, 0.3, 0.6, 0.9),         # upper case in letters
    "symbol": (0.0, 0.01, 0.03, 0.08, 0.2, 0.4),      # neither letter, digit, space nor .,;:'-
    "stop": (0.0, 0.01, 0.03, 0.06, 0.12),            # .,;:'- in bytes
    "digit": (0.0, 0.02, 0.1, 0.3),
    "bar": (0.0, 0.02, 0.1, 0.3),                     # words that are one symbol
    "again": (0.0, 0.02, 0.1, 0.3, 0.6),              # words equal to the one before
    "known": (0.2, 0.4, 0.6, 0.75, 0.9, 0.99),        # distinct words in words
    "word": (2.0, 3.0, 4.0, 5.0, 6.5, 8.0, 12.0),     # bytes in a word
    "words": (0.0, 1.0, 3.0, 8.0, 20.0, 60.0, 200.0),
    "closed": (0.5,),                                 # ends like a sentence
}
_SIZES = [len(e) + 1 for e in BINS.values()]
_FIRST = np.concatenate(([0], np.cumsum(_SIZES)))
OWN = int(_FIRST[-1])
NONE = OWN                      # a neighbour that isn't there
WIDTH = 3 * (OWN + 1)           # own line, line before, line after

_CLASS = np.full(256, 5, np.uint8)                    # 5: symbol
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("a"):ord("z") + 1] = 2
_CLASS[0x80:] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[ord(c) for c in ".,;:'-"]] = 4


#: Names by which the words of a line are compared.
_WORDS = Names((1_000_003, 998_244_353), PIECE)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, length and feature bins (one column a feature) of all lines."""
    breaks = np.flatnonzero(data == 10)
    text = np.concatenate((np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1))
    start = np.concatenate((offsets[:-1], breaks + 1))
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    last = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
    end = np.where(last, offsets[text + 1], np.append(start[1:] - 1, 0))
    size = end - start

    kinds = _CLASS[data]
    count = []
    for k in range(6):
        seen = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kinds == k, out=seen[1:])
        count.append(seen[end] - seen[start])
    letters = np.maximum(count[1] + count[2], 1)

    w_start, w_end, _ = word_bounds(data, offsets)
    rank = word_names(data, w_start, w_end, _WORDS)
    lo, hi = np.searchsorted(w_start, start), np.searchsorted(w_start, end)
    words = hi - lo
    line = np.repeat(np.arange(len(start)), words)
    some = np.maximum(words, 1)
    same = np.zeros(len(rank), bool)
    same[1:] = (rank[1:] == rank[:-1]) & (line[1:] == line[:-1])
    by = np.lexsort((rank, line))
    fresh = np.ones(len(rank), bool)
    fresh[1:] = (rank[by][1:] != rank[by][:-1]) | (line[by][1:] != line[by][:-1])
    single = (w_end - w_start == 1) & (_CLASS[data[w_start]] == 5) if len(rank) else np.zeros(0, bool)
    total = lambda mask: np.bincount(line, weights=mask, minlength=len(start))
    final = np.zeros(len(start), bool)
    full = words > 0
    final[full] = np.isin(data[w_end[hi[full] - 1] - 1], [ord(c) for c in ".!?:;,\"'"])

    values = {
        "upper": count[1] / letters, "symbol": count[5] / np.maximum(size, 1), "stop": count[4] / np.maximum(size, 1),
        "digit": count[3] / np.maximum(size, 1), "bar": total(single) / some, "again": total(same) / some,
        "known": np.bincount(line[by], weights=fresh, minlength=len(start)) / some,
        "word": total(w_end - w_start) / some, "words": words, "closed": final,
    }
    bins = np.stack([np.searchsorted(edges, values[name], "left") + _FIRST[i]
                     for i, (name, edges) in enumerate(BINS.items())], axis=1)
    return text, size, bins


def with_neighbours(text: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Feature numbers of each line: its own, the last line's, the next line's."""
    n, k = bins.shape
    out = np.full((n, 3 * k), NONE, np.int64)
    out[:, :k] = bins
    if n > 1:
        tied = (text[1:] == text[:-1])[:, None]
        out[1:, k:2 * k] = np.where(tied, bins[:-1], NONE)
        out[:-1, 2 * k:] = np.where(tied, bins[1:], NONE)
    out[:, k:2 * k] += OWN + 1
    out[:, 2 * k:] += 2 * (OWN + 1)
    return out


@dataclass
class Model:
    """``weights``: a feature's weight for good; ``pairs[i][j]``: weight of
    label j after label i; the logistic curve is ``slope * logit + shift``."""

    weights: np.ndarray
    bias: float
    pairs: np.ndarray
    slope: float
    shift: float

    def marginals(self, odds: list[float]) -> list[float]:
        """Log-odds of good of one text's lines, from their own log-odds.

        With two labels a message is one number, the log-odds that it gives."""
        (bb, bg), (gb, gg) = np.exp(self.pairs).tolist()
        onward, message = [], 0.0
        for e in odds:
            onward.append(message)
            x = exp(max(-40.0, min(40.0, e + message)))
            message = log((gg * x + bg) / (gb * x + bb))
        out, message = [0.0] * len(odds), 0.0
        for i in range(len(odds) - 1, -1, -1):
            out[i] = odds[i] + onward[i] + message
            x = exp(max(-40.0, min(40.0, odds[i] + message)))
            message = log((gg * x + gb) / (bg * x + bb))
        return out

    def means(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Length-weighted mean probability of good of each text."""
        text, size, bins = line_features(data, offsets)
        odds = self.weights[with_neighbours(text, bins)].sum(axis=1) + self.bias
        cut = np.searchsorted(text, np.arange(len(offsets)))
        flat: list[float] = []
        values = odds.tolist()
        for a, b in zip(cut, cut[1:]):
            flat += self.marginals(values[a:b])
        good = 1 / (1 + np.exp(-np.clip(flat, -40, 40)))
        length = np.maximum(size, 1)
        n = len(offsets) - 1
        return np.bincount(text, weights=good * length, minlength=n) / np.bincount(text, weights=length, minlength=n)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        mean = np.clip(self.means(data, offsets), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(mean / (1 - mean)) + self.shift)))


def _adam(value: np.ndarray, gradient, steps: int, rate: float) -> np.ndarray:
    m, v = np.zeros_like(value), np.zeros_like(value)
    for t in range(1, steps + 1):
        g = gradient(value)
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        value = value - rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return value


def fit_lines(features: np.ndarray, good: np.ndarray, weight: np.ndarray, steps: int = 200) -> np.ndarray:
    """Logistic weights (and last the bias) of single lines."""
    def gradient(w: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(w[features].sum(axis=1) + w[-1], -40, 40)))
        d = (p - good) * weight
        g = 1e-3 * w
        g[:-1] += np.bincount(features.ravel(), weights=np.repeat(d, features.shape[1]), minlength=WIDTH)
        g[-1] += d.sum()
        return g
    return _adam(np.zeros(WIDTH + 1), gradient, steps, 0.1)


def _joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log-weights of all paths through x[..., a, b], then y[..., b, c]."""
    return np.logaddexp.reduce(x[..., :, :, None] + y[..., None, :, :], axis=-2)


class Passes:
    """Forward and backward sums over chains of lines, for all chains at once.

    Chains are walked in segments: a segment's lines are first multiplied to
    one 2 x 2 table, the tables are walked along the chain, and then the lines
    of all segments with what enters them.  So a chain of n lines takes some
    n / segment + 3 * segment steps."""

    def __init__(self, chains: np.ndarray, segment: int = 64):
        """``chains`` numbers the lines' chains in order."""
        head = np.append(True, chains[1:] != chains[:-1])
        begin = np.flatnonzero(head)
        step = np.arange(len(chains)) - np.repeat(begin, np.diff(np.append(begin, len(chains))))
        first = np.flatnonzero(step % segment == 0)
        size = np.diff(np.append(first, len(chains)))
        self.tied = ~head[1:]
        self.last = first + size - 1
        number = step[first] // segment           # of the segment in its chain
        self.inner = number > 0
        self.more = np.append(self.inner[1:], False)      # another segment follows
        self.levels = [np.flatnonzero(number == k) for k in range(1, int(number.max()) + 1)]
        self.order = np.argsort(-size, kind="stable")
        # line of each segment at step t, longest segments first
        sizes = size[self.order]
        self.at = [first[self.order[:int(np.searchsorted(-sizes, -t, "left"))]] + t for t in range(int(sizes[0]))]

    def run(self, e: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-sums over all labels of the lines up to each (itself included),
        and of those after it, by its label; ``e`` are the lines' own weights."""
        table = pairs + e[self.at[0]][:, None, :]
        fresh = e[self.at[0]].copy()                # a chain's first segment has nothing before it
        for rows in self.at[1:]:
            n = len(rows)
            table[:n] = _joined(table[:n], pairs[None] + e[rows][:, None, :])
            fresh[:n] = _joined(fresh[:n, None, :], pairs[None] + e[rows][:, None, :])[:, 0]
        tables, leave = np.empty_like(table), np.empty_like(fresh)
        tables[self.order], leave[self.order] = table, fresh
        for own in self.levels:
            leave[own] = _joined(leave[own - 1][:, None, :], tables[own])[:, 0]
        beyond = np.zeros_like(leave)
        for own in reversed(self.levels):
            beyond[own - 1] = np.logaddexp.reduce(tables[own] + beyond[own][:, None, :], axis=2)
        onward, back = np.empty_like(e), np.zeros_like(e)
        start = self.at[0]
        onward[start] = e[start]
        enters = self.inner[self.order]
        rows, before = start[enters], self.order[enters] - 1
        onward[rows] += np.logaddexp.reduce(leave[before][:, :, None] + pairs, axis=1)
        for rows, after in zip(self.at, self.at[1:]):
            onward[after] = e[after] + np.logaddexp.reduce(onward[rows[:len(after)]][:, :, None] + pairs, axis=1)
        back[self.last] = beyond
        for rows, after in zip(self.at[-2::-1], self.at[:0:-1]):
            back[rows[:len(after)]] = np.logaddexp.reduce(pairs + (e[after] + back[after])[:, None, :], axis=2)
        return onward, back


def field_gradient(features: np.ndarray, good: np.ndarray, chains: np.ndarray, weight: np.ndarray, segment: int = 64):
    """The gradient of the negative log-likelihood by the weights of the
    features, the bias and the four pairs (a small quadratic penalty added);
    a line and the pair that it ends weigh ``weight``."""
    passes = Passes(chains, segment)
    y = good.astype(np.int64)
    tied = passes.tied
    pair_weight = weight[1:][tied]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][tied], y[1:][tied]), pair_weight)

    def gradient(w: np.ndarray) -> np.ndarray:
        pairs = w[WIDTH + 1:].reshape(2, 2)
        e = np.zeros((len(y), 2))
        e[:, 1] = w[features].sum(axis=1) + w[WIDTH]
        onward, back = passes.run(e, pairs)
        joint = onward + back
        p = np.exp(joint - np.logaddexp.reduce(joint, axis=1)[:, None])
        d = (p[:, 1] - good) * weight
        g = 1e-3 * w
        g[:WIDTH] += np.bincount(features.ravel(), weights=np.repeat(d, features.shape[1]), minlength=WIDTH)
        g[WIDTH] += d.sum()
        two = (onward[:-1][tied][:, :, None] + pairs + (e[1:] + back[1:])[tied][:, None, :])
        two = np.exp(two - np.logaddexp.reduce(two, axis=(1, 2))[:, None, None])
        g[WIDTH + 1:] += ((two * pair_weight[:, None, None]).sum(axis=0) - seen).ravel()
        return g
    return gradient


def fit_field(features: np.ndarray, good: np.ndarray, chains: np.ndarray, weight: np.ndarray,
              steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights (and last the bias) and pair weights of the random field
    by conditional likelihood; ``chains`` numbers the lines' chains in order."""
    w = _adam(np.zeros(WIDTH + 5), field_gradient(features, good, chains, weight), steps, 0.1)
    return w[:WIDTH + 1], w[WIDTH + 1:].reshape(2, 2)


def fit_curve(mean: np.ndarray, label: np.ndarray, steps: int = 400) -> tuple[float, float]:
    """Slope and shift that turn mean line probabilities into label odds."""
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    x = np.log(mean / (1 - mean))
    cost = np.where(label == 1, 0.5 / max(label.mean(), 1e-9), 0.5 / max(1 - label.mean(), 1e-9)) / len(label)

    def gradient(w: np.ndarray) -> np.ndarray:
        d = (1 / (1 + np.exp(-np.clip(w[0] * x + w[1], -40, 40))) - label) * cost
        return np.array([(d * x).sum() + 1e-3 * (w[0] - 1), d.sum() + 1e-3 * w[1]])
    slope, shift = _adam(np.array([1.0, 0.0]), gradient, steps, 0.05)
    return float(max(slope, 0.05)), float(shift)


def train(texts: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """A model from (line sizes, line bins, label) of the labelled texts; a
    text is one chain, whatever its length."""
    label = np.array([t[2] for t in texts])
    if len(set(label.tolist())) < 2:
        p = float(np.clip(label.mean() if len(label) else 0.5, 0.01, 0.99))
        return Model(np.zeros(WIDTH), 0.0, np.zeros((2, 2)), 0.05, log(p / (1 - p)))
    rows = np.array([len(t[0]) for t in texts])
    text = np.repeat(np.arange(len(texts)), rows)
    size = np.concatenate([t[0] for t in texts])
    features = with_neighbours(text, np.concatenate([t[1] for t in texts]))
    length = np.maximum(size, 1)
    whole = np.bincount(text, weights=length)
    # each document weighs the same within its class, both classes the same
    per_doc = np.where(label == 1, 0.5 / (label == 1).sum(), 0.5 / (label == 0).sum())
    weight = length / whole[text] * per_doc[text]
    y = label[text].astype(np.float64)
    w = fit_lines(features, y, weight)
    odds = w[features].sum(axis=1) + w[-1]
    # a bad document's lines are bad where they look it, its worst line always
    worst = np.full(len(texts), np.inf)
    np.minimum.at(worst, text, odds)
    good = np.where(label[text] == 1, 1.0, (odds > 0) & (odds > worst[text]))
    w, pairs = fit_field(features, good, text, weight * len(texts))
    model = Model(w[:-1], float(w[-1]), pairs, 1.0, 0.0)
    odds = features_odds(model, features)
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    flat: list[float] = []
    for a, b in zip(cut, cut[1:]):
        flat += model.marginals(odds[a:b].tolist())
    p = 1 / (1 + np.exp(-np.clip(flat, -40, 40)))
    model.slope, model.shift = fit_curve(np.bincount(text, weights=p * length) / whole, label)
    return model


def features_odds(model: Model, features: np.ndarray) -> np.ndarray:
    return model.weights[features].sum(axis=1) + model.bias


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> Model:
    """A model from at most ``per_class`` labelled documents of each class,
    none of them from the held-out fold."""
    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, size, bins = line_features(*text_bytes(batch.column("text")))
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"),
             pa.array([size[a:b].astype("<u4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
             pa.array([bins[a:b].astype(np.uint8).tobytes() for a, b in zip(cut, cut[1:])], pa.binary())],
            ["doc_id", "label", "sizes", "bins"])

    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, per_class)
    rows = map_blocks(sample, block, "doc_id long, label int, sizes binary, bins binary").collect()
    rows.sort(key=lambda r: r.doc_id)
    return train([(np.frombuffer(r.sizes, "<u4").astype(np.int64),
                   np.frombuffer(r.bins, np.uint8).reshape(-1, len(BINS)).astype(np.int64), r.label) for r in rows])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    held = shared(docs.sparkSession, model)

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = held().scores(*text_bytes(batch.column("text")))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return map_blocks(id_text(docs), block, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = 1500) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    found = scores(docs, fit(docs, labels, per_class))
    return found.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, unchanged."""
    held = shared(docs.sparkSession, model)

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = held().scores(*text_bytes(batch.column("text").cast(pa.string()))) >= threshold
        return batch.filter(pa.array(keep))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_blocks(docs, block, schema)
