"""Removal of byte strings that occur elsewhere, by prefix doubling.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else, in the same document or another, goes.  Spark sorts pairs of position
ranks at growing offsets and numbers those that occur twice, until a position
is unique or past ``length``.  ``windows.py`` says how positions are thinned
first, without loss, and how ranks grow.

Inputs: a null text is empty; texts shorter than ``length`` lose nothing;
strings are judged on the input and may overlap each other and themselves;
rows that repeat a doc_id, or have none, are documents of their own; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import ROW, id_text, map_blocks, text_bytes, with_row_keys
from ratingflow.llm.windows import SPANS, cell_width, covered_mask, repeated, span_arrays, with_stretches

#: A byte's name has the byte and one at both points.
_BYTE = np.arange(1, 257, dtype=np.uint64) * np.uint64((1 << 31) + 1)


def byte_symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    return _BYTE[data], offsets


def widest_gram(length: int) -> int:
    """The widest gram, up to 64 bytes, that has another beside it in a string
    of ``length`` bytes wherever it stands."""
    return max(1, min(64, (length + 1) // 3))


def repeated_bytes(docs: DataFrame, length: int = 200, gram: int | None = None) -> DataFrame:
    """(doc_id, a, b): byte stretches covered by strings found elsewhere; no two
    rows of ``docs`` share a doc_id."""
    gram = gram or widest_gram(length)
    return repeated(docs, byte_symbols, length, gram, later=False, wide=cell_width(length, gram))


def dedup(docs: DataFrame, length: int = 200, gram: int | None = None) -> DataFrame:
    """(doc_id, kept binary, n_bytes, n_removed, n_spans) of every row;
    ``kept`` are the remaining bytes in their order."""
    docs = with_row_keys(id_text(docs))

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column("text"))
        kept, n_bytes, n_removed, n_spans = [], [], [], []
        for i, spans in enumerate(span_arrays(batch.column(SPANS))):
            own = data[offsets[i]:offsets[i + 1]]
            n_bytes.append(len(own))
            if spans is None:
                kept.append(own.tobytes())
                n_removed.append(0)
                n_spans.append(0)
                continue
            gone = covered_mask(len(own), spans)
            kept.append(own[~gone].tobytes())
            n_removed.append(int(gone.sum()))
            n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(n_bytes, pa.int64()),
             pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64())],
            ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return map_blocks(with_stretches(docs, repeated_bytes(docs.select(F.col(ROW).alias("doc_id"), "text"), length, gram)), block,
                      "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


