"""Packing of tokenised documents into sequences: sum of squares.

A document is tokenised whole, ended by id 0, and cut only if it is longer
than a sequence: into full pieces, the first of which may be shorter.  Pieces
are placed one by one, the longest first, into the open sequence that leaves
the squared counts of open sequences per residual gap smallest; a new
sequence is opened only where none has room, as few are wanted.

The pieces are dealt evenly to groups of about ``group_rows``, packed side by
side.  Sequences that a group leaves more than an eighth empty are dissolved
and their pieces packed again in fewer groups, until one group is left or
that no longer helps.

Inputs: a null or empty text is one id 0; rows that repeat a doc_id are
packed one by one; a null doc_id is carried along; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import json
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
import tiktoken.registry
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import free_name, id_text, map_blocks, saved

# Fixed value: the word pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 0


class ByteTokenizer:
    """Ids of a byte-level BPE vocabulary file (tokenizers' JSON format).

    tiktoken runs the same vocabulary several times as fast; a text that it
    gives up on goes to ``tokenizers`` itself."""

    def __init__(self, spec: str):
        self.spec = spec
        self.slow = None
        name = "byte-bpe-" + hashlib.sha256(spec.encode()).hexdigest()
        held = tiktoken.registry.ENCODINGS      # one per worker process
        if name not in held:
            data = json.loads(spec)
            special = {t["content"]: t["id"] for t in data["added_tokens"]}
            to_byte = byte_letters()
            ranks = {bytes(to_byte[c] for c in piece): i for piece, i in data["model"]["vocab"].items()
                     if piece not in special}
            held[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.fast = held[name]

    def ids(self, text: str) -> np.ndarray:
        try:
            found = self.fast.encode(text, allowed_special="all")
        except BaseException as e:  # its regex engine panics on some very long runs
            if not (isinstance(e, ValueError) or type(e).__name__ == "PanicException"):
                raise
            if self.slow is None:
                self.slow = tokenizers.Tokenizer.from_str(self.spec)
            found = self.slow.encode(text, add_special_tokens=False).ids
        return np.array(found, dtype="<u4")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces(docs: DataFrame, vocabulary: str, size: int = 2048, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document.

    ``vocabulary`` is the path of the tokenizer file on the driver."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    held: list[ByteTokenizer] = []

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(ByteTokenizer(spec.value))
        rows, out = [], ([], [], [], [], [])
        for i, text in enumerate(batch.column("text").to_pylist()):
            ids = np.append(held[0].ids(text), np.uint32(END)).astype("<u4")
            first = len(ids) % size or size
            cuts = [0, *range(first, len(ids) + 1, size)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                rows.append(i)
                for col, x in zip(out, (k, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b])):
                    col.append(x)
        cols = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(out[0], pa.int32()),
                *(pa.array(c, pa.int64()) for c in out[1:4])]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            cols.append(pa.array(out[4], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_blocks(id_text(docs), block, schema + (", ids array<int>" if with_ids else ""))


def place(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, given the longest first."""
    counts = np.zeros(size + 1, np.int64)          # open sequences per gap
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened = 0
    for i, n in enumerate(lengths.tolist()):
        # change of the sum of squares if a gap g shrinks to g - n (no gap at
        # g = n): 2 (counts[g - n] - counts[g]) + 2, without its constant
        change = counts[:size - n] - counts[n:size]
        open_ = counts[n:size] > 0
        if n < size and open_.any():
            change = 2 * change
            change[0] -= 1
            gap = n + int(np.where(open_, change, np.iinfo(np.int64).max).argmin())
            seq = stacks[gap].pop()
            counts[gap] -= 1
        else:
            gap, seq = size, opened
            opened += 1
        where[i], offset[i] = seq, size - gap
        if gap > n:
            counts[gap - n] += 1
            stacks[gap - n].append(seq)
    return where, offset


def pack(rows: DataFrame, size: int = 2048, group_rows: int = 1 << 16, rounds: int = 8) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``rows`` has a column
    ``length`` of 1 to ``size`` and any others."""
    keep = rows.columns
    own_group, own_fill = free_name(rows, "__group"), free_name(rows, "__fill")
    whole = rows.where(F.col("length") >= size).select(
        "*", (F.monotonically_increasing_id() + F.lit(1 << 61)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    schema += f", `{own_fill}` long, sequence_id long, offset long"

    def group_packer(turn: int):
        def run(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("length", ascending=False, kind="stable")
            seq, offset = place(part["length"].to_numpy(), size)
            fill = np.bincount(seq, weights=part["length"].to_numpy()).astype(np.int64)
            first = (turn << 56) | (int(part[own_group].iloc[0]) << 24)
            return part.drop(columns=own_group).assign(**{own_fill: fill[seq], "sequence_id": first + seq, "offset": offset})
        return run

    todo, done, before = rows.where(F.col("length") < size), whole, None
    for turn in range(rounds):
        n = todo.count()
        if not n:
            break
        groups = -(-n // group_rows)
        dealt = todo.withColumn(own_group, F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
        packed = saved(dealt.groupBy(own_group).applyInPandas(group_packer(turn), schema), "packed")
        last = groups == 1 or turn == rounds - 1 or (before is not None and n > before // 2)
        good = F.lit(True) if last else F.col(own_fill) >= size - size // 8
        done = done.unionByName(packed.where(good).drop(own_fill))
        if last:
            break
        todo, before = packed.where(~good).select(keep), n
    return done


def pack_documents(docs: DataFrame, vocabulary: str, size: int = 2048, group_rows: int = 1 << 16,
                   with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    return pack(saved(pieces(docs, vocabulary, size, with_ids), "pieces"), size, group_rows)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from placed pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (placed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids")))
