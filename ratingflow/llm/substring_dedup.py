"""Removal of word windows that occur earlier, by level-wise doubling.

A window is ``length`` consecutive words.  Windows of a quarter of that length
that are repeated are extended to half of it, those repeated then to all of it
(5, 10, 20 words), each time by the pair of ranks of its halves.  Each word
covered by a window that also starts earlier (smaller doc_id, of equal ids the
smaller text, or further left in the same document) goes.  ``windows.py`` says
how the first level is thinned without loss.

Inputs: words are runs of bytes other than space and tab to carriage return;
a null or empty text has none; documents shorter than a window lose nothing;
windows are judged on the input; rows that repeat a doc_id, or have none, are
documents of their own; a null doc_id is the smallest id; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import ROW, id_text, map_blocks, set_aside, text_bytes, with_row_keys
from ratingflow.llm.windows import PRIME, SPANS, Names, covered_mask, new_points, repeated, span_arrays, with_stretches

#: A byte's name has the byte and one at both points.
_BYTE = np.arange(1, 257, dtype=np.uint64) * np.uint64((1 << 31) + 1)
#: Bytes whose words are named at once.
PIECE = 1 << 16
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the n+1 word offsets of the texts."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid[1:] & (~solid[:-1] | edge))
    ends = np.flatnonzero(solid[:-1] & (~solid[1:] | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, names: Names) -> np.ndarray:
    """A name for each word; ``names`` has powers for ``PIECE`` bytes."""
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):      # long texts in pieces, to bound the arrays
        stop = int(np.searchsorted(ends, starts[at] + PIECE, "right"))
        if stop > at:
            base = starts[at]
            prefix = names.prefix(_BYTE[data[base:ends[stop - 1]]])
            out[at:stop] = names.of(prefix, starts[at:stop] - base, ends[at:stop] - base)
        else:
            stop = at + 1
            out[at] = long_name(data[starts[at]:ends[at]], names)
        at = stop
    return out


def long_name(word: np.ndarray, names: Names) -> np.uint64:
    """The name of a word of more than a piece, from those of its pieces."""
    total = [0, 0]
    for at in range(0, len(word), PIECE):
        part = word[at:at + PIECE]
        name = int(names.of(names.prefix(_BYTE[part]), np.array([0]), np.array([len(part)]))[0])
        for k, value in enumerate((name >> 31, name & PRIME)):
            total[k] = (total[k] + value * pow(names.points[k], at, PRIME)) % PRIME
    return np.uint64(total[0] << 31 | total[1])


def word_symbols(points: tuple[int, int]):
    """A function that gives the names of the texts' words end to end, and the
    word offsets."""
    held: list[Names] = []

    def symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not held:
            held.append(Names(points, PIECE))
        data, offsets = text_bytes(column)
        starts, ends, words = word_bounds(data, offsets)
        return word_names(data, starts, ends, held[0]), words
    return symbols


def repeated_words(docs: DataFrame, length: int = 20) -> DataFrame:
    """(doc_id, a, b): word stretches covered by windows that start earlier; no
    two rows of ``docs`` share a doc_id."""
    return repeated(docs, word_symbols(new_points()), length, max(1, length // 4), later=True)


def dedup(docs: DataFrame, length: int = 20) -> DataFrame:
    """(doc_id, kept string, n_words, n_removed) of every row; ``kept``
    has the remaining words joined by one space."""
    docs = with_row_keys(id_text(docs))

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, n_words, n_removed = [], [], []
        texts = batch.column("text")
        for i, spans in enumerate(span_arrays(batch.column(SPANS))):
            words = texts[i].as_py().encode().split()
            n_words.append(len(words))
            if spans is not None:
                gone = covered_mask(len(words), spans)
                n_removed.append(int(gone.sum()))
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            else:
                n_removed.append(0)
            kept.append(b" ".join(words).decode())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()),
             pa.array(n_removed, pa.int64())], ["doc_id", "kept", "n_words", "n_removed"])

    return map_blocks(with_stretches(docs, repeated_words(docs.select(F.col(ROW).alias("doc_id"), "text"), length)), block,
                      "doc_id long, kept string, n_words long, n_removed long")


def rewrite(docs: DataFrame, length: int = 20) -> DataFrame:
    """``docs`` with the repeated words taken out of their texts, and ``n_chars``
    made to fit if there is such a column.  A text that loses no word stays as
    it is, spacing included; a document that loses all its words goes."""
    names = docs.columns
    docs, columns = set_aside(docs)
    keyed = with_row_keys(docs)
    rows = with_stretches(keyed, repeated_words(id_text(keyed.withColumn("doc_id", F.col(ROW))), length))

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column("text").to_pylist()
        chars = batch.column("n_chars").to_pylist() if "n_chars" in columns else None
        keep = np.ones(batch.num_rows, bool)
        for i, spans in enumerate(span_arrays(batch.column(SPANS))):
            if spans is None:
                continue
            words = text[i].encode().split()
            gone = covered_mask(len(words), spans).tolist()
            keep[i] = not all(gone)
            text[i] = b" ".join(w for w, g in zip(words, gone) if not g).decode()
            if chars is not None:
                chars[i] = len(text[i])
        new = {"text": text, "n_chars": chars}
        out = [pa.array(new[c], batch.column(c).type) if new.get(c) is not None else batch.column(c) for c in columns]
        return pa.RecordBatch.from_arrays(out, columns).filter(pa.array(keep))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_blocks(rows, block, schema).toDF(*names)
