"""Language ID from unigram pieces, summed over all segmentations.

The pieces of a fixed public vocabulary get a probability in each language.
A word's probability is the sum over every way to cut it into pieces, found
by a forward pass; a text's is the product over its words.  Probabilities are
learned by expectation maximisation: word counts of each language are gathered
from all labelled rows outside the held-out fold, and forward-backward passes
over them count each piece as often as it is expected in a segmentation.

A word is a run of letters and combining marks, lower-cased, with the
vocabulary's word-start mark before it; more than ``LONGEST`` of them on end
are taken in stretches.

Inputs: a text that is null or has no letter is ``und`` with score 0, as is
every text if no row has a language; equally likely languages are taken in
alphabetical order; rows that repeat a doc_id are predicted one by one; other
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import fold, map_blocks, mix, saved, shared, small_rows

HELD_OUT = 2
FOLDS = 4
LONGEST = 30
UNKNOWN = "und"
MARK = "▁"
_WORD = regex.compile(r"[\p{L}\p{M}]{1,%d}" % LONGEST)
_ASCII_WORD = re.compile("[a-z]{1,%d}" % LONGEST)
_LETTER = regex.compile(r"\p{L}")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 1 << 20
#: Sums over segmentations below this are done again with logarithms.
_TINY = 1e-250


def vocabulary_pieces(path: str) -> list[str]:
    """The pieces of a sentencepiece model that can stand in a word."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    return sorted(p for p in found if p and MARK not in p[1:] and len(p) <= LONGEST + 1
                  and (p == MARK or regex.fullmatch(r"[\p{L}\p{M}]+", p.lstrip(MARK))) and p == p.lower())


def words_of(text: str) -> list[str]:
    text = text.lower()
    return _ASCII_WORD.findall(text) if text.isascii() else _WORD.findall(text)


class Pieces:
    """Look-up of pieces by their code points; the last row, ``len(keys)``,
    stands for a single letter outside the vocabulary."""

    def __init__(self, pieces: list[str]):
        self.keys = np.array([self.key(p) for p in pieces], dtype=np.uint64)
        self.longest = max(map(len, pieces))
        self.size = len(pieces)
        # a piece's row stands in one of two tables, by other bits of its key
        self.slots = np.full((2, _SLOTS), -1, np.int32)
        for row, key in enumerate(self.keys.tolist()):
            for side in (0, 1):
                if self.slots[side, key >> 20 * side & _SLOTS - 1] < 0:
                    self.slots[side, key >> 20 * side & _SLOTS - 1] = row
                    break
            else:
                raise ValueError("the vocabulary is too large for its look-up tables")

    @staticmethod
    def key(piece: str) -> np.uint64:
        key = np.zeros(1, np.uint64)
        for c in piece:
            key = key * _STEP + np.uint64(ord(c) + 1)
        return mix(key + np.uint64(len(piece)))[0]

    def find(self, key: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if it isn't a piece."""
        mask = np.uint64(_SLOTS - 1)
        row = self.slots[0][key & mask]
        found = np.where((row >= 0) & (self.keys[row] == key), row, -1)
        other = (row >= 0) & (found < 0)
        if other.any():
            row = self.slots[1][(key[other] >> np.uint64(20)) & mask]
            found[other] = np.where((row >= 0) & (self.keys[row] == key[other]), row, -1)
        return found

    def lattice(self, words: list[str]) -> list[tuple[int, int, np.ndarray]]:
        """For words of one length: (start, end, row or -1 of each word)."""
        n = len(words[0]) + 1
        points = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le"), np.uint32)
        points = points.reshape(len(words), n).astype(np.uint64) + np.uint64(1)
        key = np.zeros((len(words), n), np.uint64)
        out = []
        for size in range(1, min(n, self.longest) + 1):
            key = key[:, :n - size + 1] * _STEP + points[:, size - 1:]
            found = self.find(mix(key + np.uint64(size)))
            if size == 1:
                found = np.where(found < 0, self.size, found)
            out += [(i, i + size, found[:, i]) for i in range(n - size + 1) if (found[:, i] >= 0).any()]
        return sorted(out, key=lambda e: e[1])


def by_length(words: list[str], most: int = 4096) -> Iterator[np.ndarray]:
    """Numbers of words of one length each, ``most`` at a time."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(size, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(order) else ():
        for at in range(0, len(part), most):
            yield part[at:at + most]


def forward(edges: list, n: int, prob: np.ndarray, count: int) -> np.ndarray:
    """alpha[end, word, language]; ``prob`` has a last row of zeros for no piece."""
    alpha = np.zeros((n + 1, count, prob.shape[1]))
    alpha[0] = 1.0
    for start, end, row in edges:
        alpha[end] += alpha[start] * prob[row]
    return alpha


def log_forward(edges: list, n: int, logs: np.ndarray, count: int) -> np.ndarray:
    """The logarithms of ``forward``, from those of the probabilities; slower,
    but no product is too small for it."""
    alpha = np.full((n + 1, count, logs.shape[1]), -np.inf)
    alpha[0] = 0.0
    for start, end, row in edges:
        alpha[end] = np.logaddexp(alpha[end], alpha[start] + logs[row])
    return alpha


def logs_of(prob: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(prob)


def word_scores(words: list[str], pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    """Log-probability of each word in each language."""
    out = np.zeros((len(words), prob.shape[1]))
    for at in by_length(words):
        part = [words[i] for i in at]
        n = len(part[0]) + 1
        total = forward(pieces.lattice(part), n, prob, len(part))[n]
        tiny = (total < _TINY).any(axis=1)
        out[at[~tiny]] = np.log(total[~tiny])
        if tiny.any():
            part = [words[i] for i in at[tiny]]
            out[at[tiny]] = log_forward(pieces.lattice(part), n, logs_of(prob), len(part))[n]
    return out


def expected(words: list[str], langs: np.ndarray, counts: np.ndarray, pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in each language, of words said ``counts``
    times in the languages numbered ``langs``."""
    wide = prob.shape[1]
    out = np.zeros((pieces.size + 1) * wide)
    for at in by_length(words):
        part = [words[i] for i in at]
        n, lang = len(part[0]) + 1, langs[at]
        edges = [(start, end, row, prob[row, lang]) for start, end, row in pieces.lattice(part)]
        alpha, beta = np.zeros((n + 1, len(part))), np.zeros((n + 1, len(part)))
        alpha[0] = 1.0
        for start, end, _, p in edges:
            alpha[end] += alpha[start] * p
        tiny = alpha[n] < _TINY
        beta[n] = np.where(tiny, 0.0, counts[at] / np.where(tiny, 1.0, alpha[n]))
        for start, end, _, p in sorted(edges, key=lambda e: -e[0]):
            beta[start] += p * beta[end]
        cell = np.concatenate([row * wide + lang for _, _, row, _ in edges])
        use = np.concatenate([alpha[start] * p * beta[end] for start, end, _, p in edges])
        if tiny.any():
            edges = [(start, end, row[tiny], p[tiny]) for start, end, row, p in edges]
            cell = np.concatenate([cell, *(row * wide + lang[tiny] for _, _, row, _ in edges)])
            use = np.concatenate([use, log_uses(edges, n, counts[at][tiny])])
        real = use > 0          # where there is no piece, p is zero
        out += np.bincount(cell[real], weights=use[real], minlength=len(out))
    return out.reshape(-1, wide)


def log_uses(edges: list, n: int, counts: np.ndarray) -> np.ndarray:
    """Expected uses of the edges one after the other, by logarithms."""
    edges = [(start, end, row, logs_of(p)) for start, end, row, p in edges]
    alpha, beta = (np.full((n + 1, len(counts)), -np.inf) for _ in range(2))
    alpha[0] = 0.0
    for start, end, _, p in edges:
        alpha[end] = np.logaddexp(alpha[end], alpha[start] + p)
    beta[n] = np.log(counts) - alpha[n]
    for start, end, _, p in sorted(edges, key=lambda e: -e[0]):
        beta[start] = np.logaddexp(beta[start], p + beta[end])
    return np.concatenate([np.exp(alpha[start] + p + beta[end]) for start, end, _, p in edges])


def padded(prob: np.ndarray) -> np.ndarray:
    """One more row, of zeros, that index -1 finds."""
    return np.vstack([prob, np.zeros((1, prob.shape[1]))])


class Model:
    def __init__(self, langs: list[str], pieces: Pieces | None, prob: np.ndarray | None):
        self.langs, self.pieces, self.prob = langs, pieces, prob


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all given rows: the languages' word counts."""
    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        bags: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            bags.setdefault(lang, Counter()).update(words_of(text))
        rows = [(lang, w, n) for lang, bag in bags.items() for w, n in bag.items()]
        lang, word, n = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string()),
                                           pa.array(n, pa.int64())], ["lang", "word", "n"])
    found = map_blocks(docs, block, "lang string, word string, n long", block_bytes=1 << 22)
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def smoothed(n: np.ndarray, floor: float, share: float) -> np.ndarray:
    """Probabilities from the expected uses ``n`` of pieces by language: each
    gets ``floor`` uses more, or, in a large language, its part of ``share`` of
    all uses, so that no piece's probability shrinks to nothing."""
    more = np.maximum(floor, share * n.sum(axis=0) / len(n))
    return (n + more) / (n + more).sum(axis=0)


def fit(docs: DataFrame, vocabulary: str, rounds: int = 2, floor: float = 0.01,
        share: float = 1e-6, most_langs: int = 1000) -> Model:
    """Piece probabilities of every language of ``docs`` (text, lang), by
    ``rounds`` of expectation maximisation from equal probabilities."""
    counts = saved(word_counts(docs), "language-words")
    langs = sorted(r.lang for r in small_rows(counts.select("lang").distinct(), most_langs, "languages"))
    if not langs:
        return Model([], None, None)
    pieces = Pieces(vocabulary_pieces(vocabulary))
    held = shared(docs.sparkSession, pieces)
    size = pieces.size
    prob = np.full((size + 1, len(langs)), 1 / (size + 1))

    def round_of(prob_now: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size + 1, len(langs)))
            at = {x: i for i, x in enumerate(langs)}
            for batch in batches:
                lang = np.array([at[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
                total += expected(batch.column("word").to_pylist(), lang, batch.column("n").to_numpy(), held(),
                                  padded(prob_now))
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])],
                                             ["piece", "lang", "n"])
        return run

    for _ in range(rounds):
        # at most pieces x languages rows, whatever the input
        rows = (counts.mapInArrow(round_of(prob), "piece long, lang long, n double")
                .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas())
        n = np.zeros_like(prob)
        n[rows["piece"], rows["lang"]] = rows["n"]
        prob = smoothed(n, floor, share)
    return Model(langs, pieces, prob)


def predict(docs: DataFrame, model: Model, cache: int = 200_000) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; score is the probability of
    the predicted language among those learned."""
    learned = shared(docs.sparkSession, model)
    held: dict[str, int] = {}
    scores: list[np.ndarray] = []

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = learned()
        found = [Counter(words_of(t)) if t and _LETTER.search(t) else Counter()
                 for t in batch.column("text").to_pylist()]
        pred, score = [UNKNOWN] * len(found), np.zeros(len(found))
        if m.langs and any(found):
            if len(held) > cache:       # bounds the memory of a task
                held.clear()
                scores.clear()
            new = list(set().union(*found) - held.keys())
            if new:
                start = len(held)
                held.update((w, start + i) for i, w in enumerate(new))
                scores.append(word_scores(new, m.pieces, padded(m.prob)))
            known = np.concatenate(scores)
            scores[:] = [known]
            for i, words in enumerate(found):
                if words:
                    own = np.fromiter(map(held.__getitem__, words), np.int64, len(words))
                    total = np.fromiter(words.values(), np.float64, len(words)) @ known[own]
                    p = np.exp(total - total.max())
                    best = int(total.argmax())
                    pred[i], score[i] = m.langs[best], p[best] / p.sum()
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred), pa.array(score)],
                                          ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_blocks(rows, block, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, vocabulary: str, rounds: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, learned from the
    rows outside the held-out fold."""
    known = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(FOLDS) != HELD_OUT))
             .select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")))
    found = predict(docs, fit(known, vocabulary, rounds))
    return found.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
