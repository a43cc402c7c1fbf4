"""Repeated windows of a corpus: doubling over sampled positions.

A window is ``length`` consecutive symbols (bytes or words) of one document.
Sorting all positions of the corpus would shuffle several times its size, so
positions are thinned first, without loss: the ``gram`` symbols with the
smallest hash inside a window are its anchor (leftmost of equals).  Equal
windows have the same anchor at the same place, hence only windows whose
anchor is repeated can be.  Consecutive windows share their anchor and form
a run, and a run is one row; runs whose whole stretches are equal collapse to
one, with the number of its copies.  Ranks then grow in Spark, each step on
what the last one left:

1. ``gram`` symbols: runs whose anchor is unique are done.
2. Twice that: the ranks at the anchor and ``gram`` symbols after it (before
   it for windows that end too soon) make a pair; sides whose pair is unique
   are done.
3. The runs that are left are cut into cells of ``wide`` neighbouring windows;
   what the windows of a cell share is its core.  The places of a core have
   ranks of ``gram`` symbols; pairs of them at growing offsets (once, twice,
   four times ``gram``, until the core is covered) are sorted and numbered, and
   the numbers are the ranks of the next step.  Cells with a unique rank are
   done.  With ``wide`` 1 the core is the window, and so is the result.
4. ``length``: the rank of its core and the symbols around it make a window.

The ranks of step 1 are names: a stretch's symbols as a polynomial at two
points modulo 2^31 - 1.  The points are drawn for each run of the operator, so
that no text can be written to collide.  Work is spread by rank; groups are
counted by partial aggregates, so a passage found in a third of all documents
costs one row a task.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingflow.llm.common import ROW, discard, map_blocks, mix, saved

#: Symbols of one document handled at once; longer documents go in slices
#: that overlap by a window.
SLICE = 1 << 17
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 20          # bits of a packed field


PRIME = (1 << 31) - 1
_P = np.uint64(PRIME)
_31 = np.uint64(31)


def _folded(x: np.ndarray) -> np.ndarray:
    """Below 2^33, and equal modulo 2^31 - 1."""
    return (x & _P) + (x >> _31)


def _reduced(x: np.ndarray) -> np.ndarray:
    """Modulo 2^31 - 1, of numbers below 2^63."""
    x = _folded(_folded(x))
    return x - (x >= _P) * _P


def new_points() -> tuple[int, int]:
    """Two points for ``Names``, drawn at random."""
    return tuple(256 + secrets.randbelow(PRIME - 512) for _ in range(2))


class Names:
    """Names of any stretch of a symbol sequence, from prefix sums.  A symbol
    is itself a name (two numbers below 2^31 - 1, the first shifted by 31)."""

    def __init__(self, points: tuple[int, int], size: int):
        self.points, self.size = points, size
        self.powers = [(self._powers(p, size), self._powers(pow(p, -1, PRIME), size)) for p in points]

    def __reduce__(self):
        return Names, (self.points, self.size)

    @staticmethod
    def _powers(point: int, size: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) <= size:
            out = np.concatenate((out, _reduced(out * np.uint64(pow(point, len(out), PRIME)))))
        return out[:size + 1]

    def prefix(self, symbols: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each point; a sum of 2^20 folded terms stays below 2^53."""
        out = []
        for part, (up, _) in zip((symbols >> _31, symbols & _P), self.powers):
            sums = np.zeros(len(symbols) + 1, np.uint64)
            np.cumsum(_folded(part * up[:len(symbols)]), out=sums[1:])
            out.append(sums)
        return tuple(out)

    def of(self, prefix: tuple[np.ndarray, ...], start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Names of [start, stop), below 2^62."""
        first, second = (_reduced(_reduced(sums[stop] - sums[start]) * down[start])
                         for sums, (_, down) in zip(prefix, self.powers))
        return (first << _31) | second


class Order:
    """A cheap hash of every gram, by which anchors are chosen.  Equal grams
    hash alike; that different ones may, too, does no harm."""

    def __init__(self, size: int):
        up = np.full(size + 1, _BASE, np.uint64)
        down = np.full(size + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)

    def grams(self, symbols: np.ndarray, size: int) -> np.ndarray:
        prefix = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(mix(symbols) * self.up[:len(symbols)], out=prefix[1:])
        n = len(prefix) - size
        return mix((prefix[size:] - prefix[:n]) * self.down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def slices(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (document, first symbol, symbols), each group at most about
    SLICE symbols; a slice starts the windows that the one before didn't."""
    group, held = [], 0
    for i, n in enumerate(np.diff(offsets).tolist()):
        for at in range(0, max(n - length + 1, 0), SLICE):
            size = min(n - at, SLICE + length - 1)
            if held + size > 2 * SLICE and group:
                yield group
                group, held = [], 0
            group.append((i, at, size))
            held += size
    if group:
        yield group


def stretch(symbols: np.ndarray, offsets: np.ndarray, group: list) -> tuple[np.ndarray, np.ndarray]:
    """The group's symbols end to end, and where each slice begins."""
    sizes = np.array([g[2] for g in group])
    if len(group) == 1 or all(g[1] == 0 for g in group) and len(group) == group[-1][0] - group[0][0] + 1 \
            and (np.diff(offsets)[group[0][0]:group[-1][0] + 1] == sizes).all():
        first = offsets[group[0][0]] + group[0][1]
        data = symbols[first:first + sizes.sum()]
    else:
        data = np.concatenate([symbols[offsets[d] + at:offsets[d] + at + n] for d, at, n in group])
    return data, np.concatenate(([0], np.cumsum(sizes)))


def runs(data: np.ndarray, begins: np.ndarray, length: int, gram: int, order: Order, names: Names):
    """The runs of one group: slice number, first window, windows, anchor
    offset in the first window, and the names of the anchor, the whole stretch
    and the grams after and before the anchor (0: no window has that side)."""
    g = order.grams(data, gram)
    low = np.uint64((1 << 22) - 1)
    packed = (g & ~low) | np.arange(len(g), dtype=np.uint64)
    least = (sliding_min(packed, length - gram + 1) & low).astype(np.int64)
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(begins, begins[1:])])
    anchor = least[starts]
    turn = np.flatnonzero((anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    head = np.concatenate(([0], turn))
    count = np.diff(np.concatenate((head, [len(starts)])))
    first, a = starts[head], anchor[head]
    deep = a - first                       # the anchor's offset in the first window
    shallow = deep - count + 1             # and in the last
    after = (shallow <= length - 2 * gram)
    before = (deep > length - 2 * gram)
    prefix = names.prefix(data)
    beside = [np.where(has, names.of(prefix, at, at + gram) + np.uint64(1), np.uint64(0))
              for has, at in ((after, np.minimum(a + gram, len(data) - gram)), (before, np.maximum(a - gram, 0)))]
    span = names.of(prefix, first, first + count + length - 1)
    span = mix(span ^ (deep * 2048 + count).astype(np.uint64) * np.uint64(_BASE))
    return np.searchsorted(begins, first, "right") - 1, first, count, deep, names.of(prefix, a, a + gram), span, *beside


def windows_of(docs: DataFrame, symbols: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]],
               length: int, gram: int, points: tuple[int, int]) -> DataFrame:
    """(key, span, right, left, doc_id, loc) for every run of every document;
    ``loc`` packs the first window, the number of windows and the anchor's offset."""
    # wherever the anchor is, a whole gram must stand after or before it
    if not 3 * gram - 1 <= length < 1 << 10:
        raise ValueError("a window holds three grams less a symbol at least and 1023 symbols at most")

    def block(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = symbols(batch.column("text"))
        out = []
        ids = np.arange(batch.num_rows)
        for group in slices(offsets, length):
            part, begins = stretch(data, offsets, group)
            which, first, count, deep, *ranks = runs(part, begins, length, gram, order_for(len(part)), names_for(len(part)))
            doc = np.array([g[0] for g in group])[which]
            at = first - begins[which] + np.array([g[1] for g in group])[which]
            out.append((*(r.view(np.int64) for r in ranks), ids[doc], (at << _STEP) | (count << 10) | deep))
        if not out:
            return None
        *ranks, doc, loc = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, ranks), batch.column("doc_id").take(pa.array(doc)), pa.array(loc)],
            ["key", "span", "right", "left", "doc_id", "loc"])

    order_for, names_for = _made_for(Order), _made_for(lambda size: Names(points, size))
    return map_blocks(docs, block, "key long, span long, right long, left long, doc_id long, loc long")


def _made_for(make: Callable) -> Callable:
    """``make`` of the largest size asked for so far."""
    held: list = [0, None]

    def get(size: int):
        if held[0] < size:
            held[:] = max(size, SLICE), make(max(size, SLICE))
        return held[1]
    return get


def first_window():
    return F.shiftright("loc", _STEP)


def last_window():
    return F.shiftright("loc", _STEP) + F.shiftright("loc", 10).bitwiseAND(F.lit(1023).cast("long")) - 1


def repeated(docs: DataFrame, symbols: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]],
             length: int, gram: int, later: bool, wide: int = 1) -> DataFrame:
    """(doc_id, a, b): stretches [a, b) of symbols covered by repeated windows.

    ``later``: only windows that also start earlier (smaller doc_id, or the
    same document further left) count; otherwise all that start elsewhere
    too.  No two rows of ``docs`` share a doc_id; stretches may overlap."""
    points = new_points()
    found = windows_of(docs, symbols, length, gram, points)
    # written on its own, so that both sides of the join are plain exchanges
    # and Spark can split a key's runs over tasks, however many they are
    keys = saved(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "anchor-keys")
    found = saved(found.join(keys, "key", "left_semi"), "anchors")
    discard(keys)
    # so are the other tables that joins read below
    spans = saved(found.groupBy("key", "span").agg(
        F.count(F.lit(1)).alias("copies"), F.first("right").alias("right"), F.first("left").alias("left"),
        F.min(F.struct("doc_id", "loc")).alias("own")), "spans")
    levels = _several(spans, ["key"], later, "several-spans")
    beside = [saved(levels.where(F.col(side) != 0).groupBy("key", side).agg(F.sum("copies").alias("n"))
                    .where("n > 1").select("key", side, F.lit(True).alias(f"go_{side}")), f"beside-{side}")
              for side in ("right", "left")]

    # whole runs
    own = F.struct("doc_id", "loc")
    covered = _covered(found.join(spans.where("copies > 1").select("key", "span", "own"), ["key", "span"]), own, later,
                       first_window(), last_window() + length)

    # cells of the spans that are left, one span for all its copies
    open_ = levels.join(beside[0], ["key", "right"], "left").join(beside[1], ["key", "left"], "left").select(
        "own", *(F.coalesce(f"go_{side}", F.lit(False)).alias(f"go_{side}") for side in ("right", "left")))
    open_ = open_.where("go_right or go_left")
    lists = (open_.select("own.doc_id", F.struct("own.loc", "go_right", "go_left").alias("run"))
             .groupBy(F.col("doc_id").alias("run_doc")).agg(F.collect_list("run").alias("runs")))
    joined = docs.select("doc_id", "text").join(lists, F.col("doc_id").eqNullSafe(F.col("run_doc")))
    cells = saved(_cells(joined.select("doc_id", "text", "runs"), symbols, length, gram, wide, points), "cells")
    whole = saved(covered, "whole-runs")
    discard(found, spans, levels, *beside)

    at = F.struct("doc_id", "at")
    cores = doubled(cells.select("doc_id", "at", "names"), len(core_places(0, length - wide + 1, gram)))
    if wide == 1:
        # a cell is a window
        kinds = saved(cores.groupBy("core").agg(F.min(at).alias("own")), "window-kinds")
        singles = saved(_merged(cores.join(kinds, "core"), at, later, length), "whole-windows")
        discard(cells, cores, kinds)
        return whole.union(singles)

    own_core = cores.withColumnsRenamed({"doc_id": "core_doc", "at": "core_at"})
    same = F.col("doc_id").eqNullSafe(F.col("core_doc")) & (F.col("at") == F.col("core_at"))
    known = saved(cells.drop("names").join(own_core, same).drop("core_doc", "core_at"), "known-cells")
    discard(cells, cores)
    kinds = saved(known.groupBy("core", "span").agg(F.count(F.lit(1)).alias("copies"), F.min(at).alias("own")), "cell-kinds")
    covered = _covered(known.drop("around").join(kinds.where("copies > 1"), ["core", "span"]), at, later,
                       F.col("at"), F.col("at") + F.col("count") - 1 + length)
    several = _several(kinds, ["core"], later, "several-cells")
    open_ = known.join(several, ["core", "span"]).where(at.eqNullSafe(F.col("own")))
    wins = open_.select("core", "doc_id", F.posexplode("around").alias("step", "win"), "at")
    wins = saved(wins.select("core", "win", "doc_id", (F.col("at") + F.col("step")).alias("at")), "windows")
    cells_whole = saved(covered, "whole-cells")
    discard(known, kinds, several)

    # single windows
    found_twice = [F.count(F.lit(1)).alias("n")]
    if later:
        found_twice.append(F.min(at).alias("own"))
    twice = saved(wins.groupBy("win", "core").agg(*found_twice).where("n > 1").drop("n"), "window-kinds")
    singles = saved(_merged(wins.join(twice, ["win", "core"]), at, later, length), "whole-windows")
    discard(wins, twice)
    return whole.union(cells_whole).union(singles)


def core_places(start, size: int, gram: int) -> list:
    """Where the grams are whose ranks, paired again and again, make the rank
    of [start, start + size): neighbours, then pairs of neighbours, and so on."""
    if size <= 2 * gram:
        return [start, start + size - gram]
    half = gram
    while 2 * half < size:
        half *= 2
    return core_places(start, half, gram) + core_places(start + size - half, half, gram)


def doubled(cells: DataFrame, n: int) -> DataFrame:
    """(doc_id, at, core): of cells with ``n`` names the rank of all, without
    those that differ from all others.  At each step the pairs of ranks that
    occur twice are sorted and numbered, and cells with another pair go."""
    ranks = [f"r{i}" for i in range(n)]
    rows = cells.select("doc_id", "at", *(F.get("names", i).alias(r) for i, r in enumerate(ranks)))
    made = []
    while len(ranks) > 1:
        pairs = list(zip(ranks[::2], ranks[1::2]))
        every = rows.select(F.explode(F.array(*(F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs))).alias("p"))
        twice = saved(every.select("p.a", "p.b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
                      "rank-pairs")
        tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        number = saved(twice.repartitionByRange(tasks, "a", "b").sortWithinPartitions("a", "b")
                       .withColumn("rank", F.monotonically_increasing_id()), "ranks")
        discard(twice)
        for a, b in pairs:
            rows = rows.join(number.withColumnsRenamed({"a": a, "b": b, "rank": f"{a}_"}), [a, b]).drop(a, b)
        rows = saved(rows.withColumnsRenamed({f"{a}_": a for a, _ in pairs}), "ranked-cells")
        discard(number, *made)
        made = [rows]
        ranks = [a for a, _ in pairs]
    out = rows.withColumnRenamed(ranks[0], "core")
    out._saved_at = rows._saved_at
    return out


def _several(kinds: DataFrame, by: list[str], later: bool, name: str) -> DataFrame:
    """The rows, one for each kind of stretch, whose key ``by`` has several
    kinds; unless ``later``, only if one of them has no copy, as all are known
    to be repeated otherwise."""
    counts = kinds.groupBy(*by).agg(F.count(F.lit(1)).alias("kinds"), F.min("copies").alias("single"))
    counts = saved(counts.where("kinds > 1" if later else "kinds > 1 and single = 1").select(*by), f"{name}-keys")
    out = saved(kinds.join(counts, by, "left_semi"), name)
    discard(counts)
    return out


def _covered(rows: DataFrame, place: Column, later: bool, a: Column, b: Column) -> DataFrame:
    """Stretches of the repeated rows; if ``later``, not of the first of each."""
    if later:
        rows = rows.where(~place.eqNullSafe(F.col("own")))
    return rows.select("doc_id", a.alias("a"), b.alias("b"))


def _merged(rows: DataFrame, place: Column, later: bool, length: int) -> DataFrame:
    """As ``_covered`` for the single windows at (doc_id, at): 64 neighbouring
    places come together as bits, and windows that follow each other make one
    stretch, so that a document's list stays short."""
    if later:
        rows = rows.where(~place.eqNullSafe(F.col("own")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    blocks = rows.groupBy("doc_id", F.shiftright("at", 6).alias("block")).agg(F.bit_or(bit).alias("bits"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
            on = np.zeros((len(bits), 66), np.int8)
            on[:, 1:-1] = np.unpackbits(bits, axis=1, bitorder="little")
            turn = np.diff(on, axis=1)
            row, first = np.nonzero(turn == 1)
            _, end = np.nonzero(turn == -1)
            base = batch.column("block").to_numpy()[row] * 64
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(base + first),
                                              pa.array(base + end - 1 + length)], ["doc_id", "a", "b"])
    return blocks.mapInArrow(spread, "doc_id long, a long, b long")


def cell_width(length: int, gram: int) -> int:
    """Windows of a cell, an eighth of those that can share an anchor."""
    return max(4, -(-(length - gram + 1) // 8))


def _cells(joined: DataFrame, symbols: Callable, length: int, gram: int, wide: int, points: tuple[int, int]) -> DataFrame:
    """The listed runs cut into cells, whose windows' offsets to the anchor
    divided by ``wide`` are the same: (doc_id, at, count, names, span, around).
    ``names`` are those of the core's grams, ``span`` names all that is around
    the core, ``around`` what is in each window."""
    names_for = _made_for(lambda size: Names(points, size))

    def block(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = symbols(batch.column("text"))
        lists = batch.column("runs")
        values = lists.flatten()
        owner = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths().fill_null(0)))
        loc, go_right, go_left = (values.field(f).to_numpy(zero_copy_only=False) for f in ("loc", "go_right", "go_left"))
        at, count, deep = loc >> _STEP, (loc >> 10) & 1023, loc & 1023
        # a run's cells: offsets fall from deep to deep - count + 1
        top, low = deep // wide, (deep - count + 1) // wide
        n = top - low + 1
        ends = np.cumsum(n)
        cell = np.repeat(top, n) - (np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n))
        run = np.repeat(np.arange(len(n)), n)
        upper = np.minimum(deep[run], (cell + 1) * wide - 1)
        lower = np.maximum((deep - count + 1)[run], cell * wide)
        border = length - 2 * gram          # offsets up to here have the gram after the anchor
        go = (go_right[run] & (lower <= border)) | (go_left[run] & (upper > border))
        run, cell, upper, lower = run[go], cell[go], upper[go], lower[go]
        first = at[run] + deep[run] - upper
        order = np.lexsort((first, owner[run]))
        run, cell, upper, lower, first = (x[order] for x in (run, cell, upper, lower, first))
        doc = owner[run]
        out = []
        for group in slices(offsets, length):
            part, begins = stretch(data, offsets, group)
            names = names_for(len(part))
            prefix = names.prefix(part)
            for (own, shift, _), begin in zip(group, begins):
                lo, hi = np.searchsorted(doc, [own, own + 1])
                lo, hi = lo + np.searchsorted(first[lo:hi], [shift, shift + SLICE])
                if lo == hi:
                    continue
                c = slice(lo, hi)
                pos = first[c] - shift + begin
                size = upper[c] - lower[c] + 1
                anchor = pos + upper[c]
                # all windows whose anchor's offset is in the cell's range hold the core
                a = anchor - cell[c] * wide
                b = a + length - wide + 1
                grams = np.stack([names.of(prefix, p, p + gram) for p in core_places(a, length - wide + 1, gram)], axis=1)
                if wide == 1:
                    span, each = np.zeros(len(pos), np.uint64), np.zeros(len(pos), np.uint64)
                else:
                    def around(x, y, of):
                        """Of the stretches [x, y), which hold the cores numbered ``of``."""
                        left, right = names.of(prefix, x, a[of]), names.of(prefix, b[of], y)
                        return mix(mix(left ^ (a[of] - x).astype(np.uint64) * np.uint64(_BASE)) + right)
                    span = around(pos, pos + size + length - 1, np.arange(len(pos)))
                    span = mix(span ^ size.astype(np.uint64))
                    ends = np.cumsum(size)
                    each = np.repeat(pos - (ends - size), size) + np.arange(ends[-1])
                    each = around(each, each + length, np.repeat(np.arange(len(pos)), size))
                out.append((doc[c], first[c], size, grams, span.view(np.int64), each.view(np.int64)))
        if not out:
            return None
        who, start, size, grams, span, each = (np.concatenate(x) for x in zip(*out))
        per = np.arange(len(grams) + 1, dtype=np.int32) * grams.shape[1]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(who)), pa.array(start), pa.array(size),
             pa.ListArray.from_arrays(pa.array(per), pa.array(grams.ravel().view(np.int64))), pa.array(span),
             pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(each))],
            ["doc_id", "at", "count", "names", "span", "around"])

    return map_blocks(joined, block, "doc_id long, at long, count long, names array<long>, span long, around array<long>")


def covered_mask(size: int, spans: list | None) -> np.ndarray:
    """Which of ``size`` symbols the stretches (a, b) cover."""
    mask = np.zeros(size + 1, np.int64)
    if spans is not None and len(spans):
        a, b = spans
        np.add.at(mask, a, 1)
        np.add.at(mask, b, -1)
    return np.cumsum(mask[:-1]) > 0


SPANS = "__spans"


def with_stretches(docs: DataFrame, stretches: DataFrame) -> DataFrame:
    """docs with the stretches of their ``ROW`` as column ``SPANS`` (null: none)."""
    lists = (stretches.groupBy(F.col("doc_id").alias("__doc"))
             .agg(F.collect_set(F.struct("a", "b")).alias(SPANS)))
    return docs.join(lists, F.col(ROW).eqNullSafe(F.col("__doc")), "left").drop("__doc")


def span_arrays(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """For each row of a ``SPANS`` column its a and b, or None."""
    values = column.flatten()
    a, b = (values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    sizes = np.asarray(column.value_lengths().fill_null(0))
    ends = np.cumsum(sizes)
    for lo, hi in zip((ends - sizes).tolist(), ends.tolist()):
        yield (a[lo:hi], b[lo:hi]) if hi > lo else None
