"""Benchmark passages in documents, by q-gram counts on diagonals.

Texts are compared lower-cased, each run of white space as one space.  An
occurrence of an item of m characters with at most k edits keeps at least
m + 1 - q (k + 1) of its q-grams, on at most k + 1 neighbouring diagonals (text
position less item position).  So shared q-grams are counted in bands of
2 (k + 1) diagonals, each overlapping the next by half; bands that reach that
number are aligned, within the band, and kept if at most k edits are needed.

The budget k is ``share`` of the item's length, or less where an item is so
short that the count would be zero: at most m / q - 1.  Items shorter than q
characters have no q-gram; they are searched for as they are, by an automaton
over all of them, and match whole words only.  Items are sent to the executors
in chunks of at most ``chunk_chars`` characters, one pass over the documents
each.

Inputs: a null or empty text holds nothing, a null item or one without any
character but white space matches nothing; rows that repeat a doc_id or an item are matched one by one; null ids
are carried along; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import id_text, map_blocks, mix, shared

Q = 8
SHARE = 0.1
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TABLE = 1 << 21
#: Hits taken at once; more are counted slice by slice.
_HITS = 1 << 20


def normal(text: str) -> str:
    """Lower case, character by character so that positions hold, one space
    for each run of white space."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return " ".join(low.split())


def origin(text: str) -> np.ndarray:
    """For each character of ``normal(text)``, its place in ``text``."""
    out, end = [], 0
    for word in text.split():
        if out:
            out.append(end)
        place = text.index(word, end)
        out.extend(range(place, place + len(word)))
        end = place + len(word)
    return np.array(out, dtype=np.int64)


def gram_keys(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit key of the q code points at each position."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    # twice the length from two halves, as q is a power of two
    key, step, have = mix(points.astype(np.uint64)), int(_STEP), 1
    while have < q:
        key = key[:-have] * np.uint64(step) + key[have:]
        step = step * step % (1 << 64)
        have *= 2
    return key ^ (key >> np.uint64(32))


@dataclass
class Index:
    """The q-grams of a chunk of items."""

    ids: list
    points: list[np.ndarray]        # an item's code points
    budget: np.ndarray              # its edits
    need: np.ndarray                # q-grams that an occurrence keeps
    keys: np.ndarray                # distinct q-grams
    first: np.ndarray               # where a q-gram's entries begin, and the end
    item: np.ndarray                # entries: item and position
    place: np.ndarray
    maybe: np.ndarray
    short: ahocorasick.Automaton | None     # items without a q-gram, by their numbers

    @staticmethod
    def of(items: list[tuple[int, str]], q: int = Q, share: float = SHARE) -> Index:
        forms = [(i, normal(t or "")) for i, t in items]
        kept = [(i, t) for i, t in forms if len(t) >= q]
        brief = [(i, t) for i, t in forms if 0 < len(t) < q]
        points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for _, t in kept]
        size = np.array([len(p) for p in points], dtype=np.int64)
        budget = np.minimum((size * share).astype(np.int64), size // q - 1)
        keys = [gram_keys(p, q) for p in points]
        item = np.repeat(np.arange(len(points)), [len(k) for k in keys])
        place = np.concatenate([np.arange(len(k)) for k in keys]) if keys else np.zeros(0, np.int64)
        flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        distinct, first = np.unique(flat[order], return_index=True)
        maybe = np.zeros(_TABLE, bool)
        maybe[distinct & np.uint64(_TABLE - 1)] = True
        short: dict[str, list[int]] = {}
        for number, (_, t) in enumerate(brief, len(kept)):
            short.setdefault(t, []).append(number)
        machine = None
        if short:
            machine = ahocorasick.Automaton()
            for t, numbers in short.items():
                machine.add_word(t, (len(t), numbers))
            machine.make_automaton()
        return Index([i for i, _ in kept + brief], points, budget, size + 1 - q * (budget + 1), distinct,
                     np.append(first, len(flat)), item[order], place[order], maybe, machine)

    def words(self, form: str) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) where a short item stands in a normal form, not
        within a word and not over an occurrence of the same item."""
        last: dict[int, int] = {}
        for at, (size, numbers) in self.short.iter(form) if self.short else ():
            start, end = at + 1 - size, at + 1
            if start and form[start - 1].isalnum() and form[start].isalnum():
                continue
            if end < len(form) and form[end].isalnum() and form[at].isalnum():
                continue
            for item in numbers:
                if last.get(item, 0) <= start:
                    last[item] = end
                    yield item, start, end

    def bands(self, points: np.ndarray, q: int = Q) -> list[tuple[int, int]]:
        """(item, band) where enough q-grams of the item meet the text."""
        key = gram_keys(points, q)
        at = np.flatnonzero(self.maybe[key & np.uint64(_TABLE - 1)])
        slot = np.minimum(np.searchsorted(self.keys, key[at]), len(self.keys) - 1)
        real = self.keys[slot] == key[at]
        at, slot = at[real], slot[real]
        size = self.first[slot + 1] - self.first[slot]
        ends = np.cumsum(size)
        found = []
        start = 0
        while start < len(at):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _HITS, "right")))
            n = size[start:stop]
            entry = np.repeat(self.first[slot[start:stop]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            item = self.item[entry]
            diagonal = np.repeat(at[start:stop], n) - self.place[entry]
            band = diagonal // (self.budget[item] + 1)
            # band b has the diagonals of steps b and b + 1
            code = (item << 40) + band + (1 << 30)
            found.append(np.unique(np.concatenate((code, code - 1)), return_counts=True))
            start = stop
        if not found:
            return []
        code, slot = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
        count = np.bincount(slot, weights=np.concatenate([n for _, n in found]))
        code = code[count >= self.need[code >> 40]]
        return list(zip((code >> 40).tolist(), ((code & ((1 << 40) - 1)) - (1 << 30)).tolist()))

    def align(self, points: np.ndarray, tasks: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int] | None]:
        """For each (item, band, lo, hi): (edits, start, end) of the item's best
        occurrence near the band within text [lo, hi), None beyond its budget."""
        out: list[tuple[int, int, int] | None] = [None] * len(tasks)
        longest_first = sorted(range(len(tasks)), key=lambda t: -len(self.points[tasks[t][0]]))
        for at in range(0, len(tasks), 256):
            part = longest_first[at:at + 256]
            for t, hit in zip(part, self._align([tasks[t] for t in part], points)):
                out[t] = hit
        return out

    def _align(self, tasks: list[tuple[int, int, int, int]], points: np.ndarray) -> list:
        item, band, lo, hi = (np.array(c, dtype=np.int64) for c in zip(*tasks))
        k = self.budget[item]
        size = np.array([len(self.points[i]) for i in item])
        # an occurrence whose q-grams lie in the band starts and ends near it
        first = band * (k + 1) - k
        width = int((4 * k + 2).max())
        place = first[:, None] + np.arange(size[0] + width)
        inside = (place >= lo[:, None]) & (place < hi[:, None])
        window = np.where(inside, points[np.clip(place, 0, len(points) - 1)].astype(np.int64), -1)
        pattern = np.zeros((len(item), size[0]), np.int64)
        for r, i in enumerate(item):
            pattern[r, :size[r]] = self.points[i]
        # a cell holds edits and, below, where the occurrence starts
        one = 1 << 32
        step = np.arange(width, dtype=np.int64) * one
        row = np.tile(np.arange(width, dtype=np.int64), (len(item), 1))   # nothing matched yet: start anywhere
        left = len(item)
        for i in range(size[0]):
            left = int(np.searchsorted(-size, -i, "left"))               # items longer than i
            old = row[:left]
            nxt = old + np.where(window[:left, i:i + width] == pattern[:left, i:i + 1], 0, one)
            nxt[:, :-1] = np.minimum(nxt[:, :-1], old[:, 1:] + one)
            row[:left] = np.minimum.accumulate(nxt - step, axis=1) + step
        best = row.argmin(axis=1)
        cell = row[np.arange(len(item)), best]
        edits, start = cell >> 32, first + (cell & (one - 1))
        return [(int(e), max(int(a), int(x)), min(int(z), int(y))) if e <= most else None for e, a, z, x, y, most in
                zip(edits, start, first + size + best, lo, hi, k)]


def occurrences(texts: list[str], index: Index) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, end) of the items' occurrences, positions in
    the normal form; of overlapping ones of an item the best is kept."""
    forms = [normal(t) for t in texts]
    size = np.array([len(f) + 1 for f in forms])
    begin = np.cumsum(size) - size
    points = np.frombuffer(("\0".join(forms) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    out = [(text, item, 0, a, b) for text, form in enumerate(forms) for item, a, b in index.words(form)]
    if not len(index.keys):
        return sorted(out)
    tasks, owner = [], []
    for item, band in index.bands(points):
        k = int(index.budget[item])
        # the band may reach into two texts
        low, high = band * (k + 1) - k, (band + 2) * (k + 1) + len(index.points[item])
        for text in range(max(int(np.searchsorted(begin, low, "right")) - 1, 0), len(texts)):
            if begin[text] >= high:
                break
            if begin[text] + len(forms[text]) > low:
                tasks.append((item, band, int(begin[text]), int(begin[text] + len(forms[text]))))
                owner.append((text, item))
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for where, hit in zip(owner, index.align(points, tasks)):
        if hit:
            found.setdefault(where, []).append(hit)
    for (text, item), hits in found.items():
        taken: list[tuple[int, int, int]] = []
        for edits, start, end in sorted(set(hits)):
            if all(end <= a or start >= b for _, a, b in taken):
                taken.append((edits, start, end))
        out += [(text, item, e, a - int(begin[text]), b - int(begin[text])) for e, a, b in taken]
    return sorted(out)


def chunks(benchmark: DataFrame, chunk_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items, at most ``chunk_chars`` characters at a time."""
    part, held = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    for item, text in rows.toLocalIterator():
        if part and held + len(text) > chunk_chars:
            yield part
            part, held = [], 0
        part.append((item, text))
        held += len(text)
    if part:
        yield part


SCHEMA = "doc_id long, item_id long, edits int, start long, end long"


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, chunk_chars: int = 1 << 21) -> DataFrame:
    """(doc_id, item_id, edits, start, end) of every occurrence of an item in a
    text, as positions of characters in the text."""
    spark = docs.sparkSession
    rows = id_text(docs)
    found = spark.createDataFrame([], SCHEMA)
    for part in chunks(benchmark, chunk_chars):
        held = shared(spark, Index.of(part, share=share))
        found = found.union(map_blocks(rows, _finder(held), SCHEMA))
    return found


def _finder(held):
    def block(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = batch.column("text").to_pylist()
        index = held()
        hits = occurrences(texts, index)
        if not hits:
            return None
        places: dict[int, np.ndarray] = {}
        for text in {h[0] for h in hits}:
            places[text] = origin(texts[text])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array([h[0] for h in hits])),
             pa.array([index.ids[h[1]] for h in hits], pa.int64()), pa.array([h[2] for h in hits], pa.int32()),
             pa.array([int(places[h[0]][h[3]]) for h in hits], pa.int64()),
             pa.array([int(places[h[0]][h[4] - 1]) + 1 for h in hits], pa.int64())],
            ["doc_id", "item_id", "edits", "start", "end"])
    return block


def clean(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, chunk_chars: int = 1 << 21) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, unchanged."""
    spark = docs.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def keeper(held):
        def block(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column("text").cast(pa.string()).to_pylist()]
            bad = {h[0] for h in occurrences(texts, held())}
            return batch.filter(pa.array([i not in bad for i in range(batch.num_rows)]))
        return block

    for part in chunks(benchmark, chunk_chars):
        docs = map_blocks(docs, keeper(shared(spark, Index.of(part, share=share))), schema)
    return docs
