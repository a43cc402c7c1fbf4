"""Blocked all-pairs vector products.

Exact all-pairs work (cosine similarity above a threshold, best-k dot
products per row) is spread over *block pairs*, as in a 2-D partitioned matrix
product:

* each side is split into hash blocks (``pmod(xxhash64(id), nb)``: even
  sizes whatever the id distribution);
* each row is replicated once per partner block (``explode(sequence)``),
  keyed by the block pair, so a plain equi-shuffle on the pair key brings
  the two blocks of a pair together - no cartesian product is planned;
* ``applyInPandas`` multiplies the two blocks with numpy in row chunks
  (bounded score matrix) and emits only what passes: pairs above the
  threshold, a frame per chunk, or exactly the best k per row.

Block counts (``plan_pair_blocks``/``plan_self_blocks``): with nl x nr
block pairs the shuffle moves N_right*nl + N_left*nr rows, and there
should be about TASKS_PER_SLOT groups per task slot.  The volume is least
for nl = sqrt(P*N_left/N_right), nr = P/nl; a block never exceeds
``max_rows`` (memory of a group) and, when the count comes from the
parallelism target, never drops below MIN_BLOCK_ROWS rows.

From PRUNE_FROM rows on, block pairs that cannot hold a result are not shipped
(``pruned.py``); the results are the same.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ratingflow.operators.runs import PackedEdges, pack
from ratingflow.operators.topk import top_k
from ratingflow.session import ensure_checkpoint_dir

# The block functions run in Python workers; ship them by value so the
# executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TASKS_PER_SLOT = 4
MIN_BLOCK_ROWS = 64
MAX_BLOCK_ROWS = 1 << 16     # rows of one side in a group (64 MB at 128 doubles)
BLOCK_BYTES = 1 << 27        # of one side of a best-k product, where the caller sets no rows
MAX_SELF_BLOCK_ROWS = 1 << 15    # of a product that hands on all pairs above, where the caller sets rows
SELF_BLOCK_BYTES = 1 << 26   # of one side of such a product, where the caller sets none
CHUNK_CELLS = 1 << 22        # score-matrix cells per GEMM chunk (32 MB of doubles)
PACK_PAIRS = 1 << 21         # pairs a task packs at a time (the more, the longer the runs)
PRUNE_FROM = 1 << 15         # rows from which looking for prunable blocks pays
PRUNE_SHARE = 0.1            # of the products, from which leaving out pairs pays
SIEVE_FROM = 4096            # right rows of a block from which single precision is tried first
SIEVE_TILE = (512, 1024)     # rows and columns of its products (2 MB, which stay in the cache)
SIEVE_SHARE = 1 / 32         # of a tile's products that may be above, for doubles one by one
PAIRS_A_FRAME = 1 << 18      # pairs above that are handed on at a time
SIEVE_MOST = 1 << 20         # products of a row tile that may be taken up for doubles


def _slots(df: DataFrame) -> int:
    """Task slots of the cluster (default parallelism)."""
    spark = df.sparkSession
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:  # e.g. a Spark Connect session has no SparkContext
        return max(1, int(spark.conf.get("spark.default.parallelism", "8")))


def _cap(by_parallelism: int, n: int, max_rows: int) -> int:
    small = min(by_parallelism, max(1, math.ceil(n / MIN_BLOCK_ROWS)))
    return max(1, small, math.ceil(n / max(1, max_rows)))


def plan_pair_blocks(n_left: int, n_right: int, slots: int,
                     max_rows: int = MAX_BLOCK_ROWS) -> tuple[int, int]:
    """(nl, nr) block counts for a left x right product."""
    if n_left == 0 or n_right == 0:
        return 1, 1
    target = TASKS_PER_SLOT * slots
    nl = max(1, round(math.sqrt(target * n_left / n_right)))
    nr = max(1, math.ceil(target / nl))
    return _cap(nl, n_left, max_rows), _cap(nr, n_right, max_rows)


def plan_self_blocks(n: int, slots: int, max_rows: int = MAX_BLOCK_ROWS) -> int:
    """nb for a symmetric product (nb(nb+1)/2 block pairs)."""
    target = TASKS_PER_SLOT * slots
    nb = math.ceil((math.sqrt(8 * target + 1) - 1) / 2)
    return _cap(nb, n, max_rows)


def block_of(id_col: str, nb: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(nb)).cast("int")


def one_per_id(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """One vector per id.  Null vectors and those holding a null or NaN don't
    count; copies collapse before blocking (blocks are hashed by id, so all
    copies of one would land in one block); an id with different vectors
    fails the job, as no choice among them would be right."""
    vec, tag = F.col(vec_col), F.xxhash64(F.col(vec_col))
    valid = F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))
    one = df.where(valid).groupBy(id_col).agg(
        F.min_by(vec, tag).alias(vec_col), F.min(tag).alias("_lo"), F.max(tag).alias("_hi"))
    clash = F.raise_error(F.concat(F.lit("different vectors for id "), F.col(id_col).cast("string")))
    return one.select(id_col, F.when(F.col("_lo") != F.col("_hi"), clash.cast("array<double>"))
                      .otherwise(F.col(vec_col)).alias(vec_col))


def unit_vectors(df: DataFrame, id_col: str, vec_col: str, unique_ids: bool = False) -> DataFrame:
    """(id, features / |features|), one per id; zero, null or NaN vectors
    are dropped (their cosine is undefined, so they have no similar items).
    ``unique_ids``: the caller guarantees one row per id (e.g. ALS factors),
    so the collapsing shuffle is skipped."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x))
    v = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    v = v.withColumn("norm", norm).where(F.col("norm").isNotNull() & ~F.isnan("norm") & (F.col("norm") > 0))
    return ((v.select("id", "v") if unique_ids else one_per_id(v.select("id", "v"), "id", "v"))
            .withColumn("norm", norm)
            .select("id", F.transform("v", lambda x: x / F.col("norm")).alias("v")))


def _matrix(col: pd.Series) -> np.ndarray:
    if len(col) == 0:
        return np.zeros((0, 0))
    return np.vstack([np.asarray(x, dtype=np.float64) for x in col])


def _chunks(n_left: int, n_right: int):
    """Row ranges of the left block so a chunk's score matrix stays under
    CHUNK_CELLS cells."""
    step = max(1, CHUNK_CELLS // max(1, n_right))
    for lo in range(0, n_left, step):
        yield lo, min(n_left, lo + step)


def _sides(frames: Iterator[pd.DataFrame]) -> tuple:
    """Ids and vectors of a group's left and right rows, ids ascending."""
    ids, vectors = ([], []), ([], [])
    for frame in frames:
        for side in (0, 1):
            own = frame[frame["side"] == side]
            ids[side].append(own["id"].to_numpy())
            vectors[side].append(_matrix(own["v"]))
    out = []
    for side in (0, 1):
        i = np.concatenate(ids[side]) if ids[side] else np.zeros(0, np.int64)
        some = [m for m in vectors[side] if len(m)]
        order = np.argsort(i, kind="stable")
        out.append((i[order], np.vstack(some)[order] if some else np.zeros((0, 0)), order))
    return out


def _unit_sides(frames: Iterator[pd.DataFrame]) -> tuple:
    """Ids and vectors of a group's left and right rows, as they come."""
    ids, vectors = ([], []), ([], [])
    for frame in frames:
        for side in (0, 1):
            own = frame[frame["side"] == side]
            if len(own):
                ids[side].append(own["id"].to_numpy())
                vectors[side].append(_matrix(own["v"]))
    out = []
    for side in (0, 1):
        if not ids[side]:
            return ()
        out.append((np.concatenate(ids[side]), np.vstack(vectors[side])))
        vectors[side].clear()
    return tuple(out)


def _above(lm: np.ndarray, rm: np.ndarray, threshold: float) -> Iterator[tuple]:
    """Per tile the left and right places and the products above ``threshold`` of unit
    vectors.  Single precision is off by less than ``err``, so that doubles
    are made only of the products that may be above; of all where these are many."""
    err = (lm.shape[1] + 8) * 2.0 ** -23
    least = np.float32(threshold - err)
    sieve = len(rm) >= SIEVE_FROM
    a, b = (lm.astype(np.float32), rm.astype(np.float32)) if sieve else (None, None)
    rows, columns = SIEVE_TILE if sieve else (max(1, CHUNK_CELLS // len(rm)), len(rm))
    dense = 0
    for lo in range(0, len(lm), rows):
        hi = min(len(lm), lo + rows)
        bounds = np.full(hi - lo, least)
        for c in range(0, len(rm), columns):
            d, few = min(len(rm), c + columns), False
            if sieve and dense < 8:     # where so many tiles in a row have many, the others will
                x, y = _hits(a[lo:hi] @ b[c:d].T, bounds, np.empty((hi - lo, d - c), bool))
                few = len(x) <= SIEVE_SHARE * (hi - lo) * (d - c)
                dense = 0 if few else dense + 1
            if few:
                s = _products_of(lm, rm, lo + x, c + y)
                keep = s > threshold
                x, y, s = x[keep], y[keep], s[keep]
            else:
                cells = lm[lo:hi] @ rm[c:d].T
                x, y = np.nonzero(cells > threshold)
                s = cells[x, y]
            if len(x):
                yield lo + x, c + y, s


def _pairs_above(key, frames: Iterator[pd.DataFrame], threshold: float) -> Iterator[tuple]:
    """A few million at a time the two ids and the cosine of each unordered pair above."""
    group = _unit_sides(frames)
    if not group:
        return
    (lid, lm), (rid, rm) = group
    half = len(key) // 2
    same_block = tuple(map(int, key[:half])) == tuple(map(int, key[half:]))
    held, n = [], 0
    for x, y, s in _above(lm, rm, threshold):
        a, b = lid[x], rid[y]
        if same_block:  # a block against itself: each unordered pair once
            once = a < b
            a, b, s = a[once], b[once], s[once]
        held.append((a.astype(np.int32), b.astype(np.int32), s))
        n += len(a)
        if n >= PAIRS_A_FRAME:
            yield tuple(np.concatenate(z) for z in zip(*held))
            held, n = [], 0
    if n:
        yield tuple(np.concatenate(z) for z in zip(*held))


def _cosine_pairs_fn(threshold: float):
    def fn(key, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # one frame a chunk: a group's output is never held whole
        for a, b, r in _pairs_above(key, frames, threshold):
            # both directions of each undirected edge
            yield pd.DataFrame({"mid": np.concatenate([a, b]), "rid": np.concatenate([b, a]),
                                "r": np.concatenate([r, r])})
    # Spark reads the hints of the function to tell the iterator form
    fn.__annotations__ = {"key": tuple, "frames": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return fn


def _cosine_runs_fn(threshold: float):
    def fn(key, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for found in _pairs_above(key, frames, threshold):
            held.append(found)
            n += len(found[0])
            if n >= PACK_PAIRS:
                a, b, r = (np.concatenate(x) for x in zip(*held))
                held, n = [], 0
                yield pack(a, b, r)
                yield pack(b, a, r)
        if held:
            a, b, r = (np.concatenate(x) for x in zip(*held))
            yield pack(a, b, r)
            yield pack(b, a, r)
    fn.__annotations__ = {"key": tuple, "frames": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return fn


def _cosine_rows_fn(threshold: float):
    def fn(key, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (lid, lm, _), (rid, rm, _) = _sides(frames)
        if len(lid) and len(rid):
            for lo, hi in _chunks(len(lid), len(rid)):
                s = lm[lo:hi] @ rm.T
                li, ri = np.nonzero((s > threshold) & (lid[lo:hi, None] != rid[None, :]))
                if len(li):
                    yield pd.DataFrame({"mid": lid[lo:hi][li].astype(np.int32), "rid": rid[ri].astype(np.int32),
                                        "r": s[li, ri]})
    fn.__annotations__ = {"key": tuple, "frames": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return fn


def _settled(df: DataFrame) -> DataFrame:
    """The vectors written once to the shared checkpoint folder: they are
    counted, to size the blocks, and read by both sides of the product."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def cosine_edges(vectors: DataFrame, threshold: float, id_col: str = "mid",
                 vec_col: str = "features", block_rows: int | None = None,
                 nb: int | None = None, unique_ids: bool = False, prune: bool | None = None) -> DataFrame:
    """(mid, rid, r): every ordered pair of distinct ids whose cosine
    similarity is strictly above ``threshold`` (both directions).
    ``block_rows`` caps the rows of one block (never above MAX_SELF_BLOCK_ROWS;
    default: by bytes).  ``prune`` (default: by size) leaves out block pairs
    that are too far apart."""
    groups, _ = _block_pairs(vectors, threshold, id_col, vec_col, block_rows, nb, unique_ids, prune)
    return groups.applyInPandas(_cosine_pairs_fn(threshold), "mid int, rid int, r double")


def packed_cosine_edges(vectors: DataFrame, threshold: float, id_col: str = "mid",
                        vec_col: str = "features", block_rows: int | None = None,
                        nb: int | None = None, unique_ids: bool = False, prune: bool | None = None) -> PackedEdges:
    """The rows of ``cosine_edges``, packed for ``runs.nest_runs``."""
    groups, n = _block_pairs(vectors, threshold, id_col, vec_col, block_rows, nb, unique_ids, prune)
    return PackedEdges(groups.applyInPandas(_cosine_runs_fn(threshold), "mid int, run binary"), n)


def _self_block_rows(block_rows: int | None, dim: int | None) -> int:
    return min(block_rows, MAX_SELF_BLOCK_ROWS) if block_rows else max(1, SELF_BLOCK_BYTES // (8 * max(1, dim or 1)))


def _block_pairs(vectors: DataFrame, threshold: float, id_col: str, vec_col: str, block_rows: int | None,
                 nb: int | None, unique_ids: bool, prune: bool | None) -> tuple[GroupedData, int]:
    """Unit vectors (side, id, v) grouped by the block pairs they are in, and their number."""
    unit = _settled(unit_vectors(vectors, id_col, vec_col, unique_ids))
    n, dim = unit.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    nb = nb or plan_self_blocks(n, _slots(unit), _self_block_rows(block_rows, dim))
    if n >= PRUNE_FROM if prune is None else prune:
        from ratingflow.operators.pruned import near_clusters
        clusters = near_clusters(unit, threshold, nb, n)
        # uneven clusters are cut into more blocks than nb; without pruning that
        # only ships the vectors more often
        if prune or clusters.skipped() >= PRUNE_SHARE:
            return clusters.rows().groupBy("bi", "si", "bj", "sj"), n
    b = unit.withColumn("b", block_of("id", nb))
    # a row of block b is the left side of pairs (b, j>=b) and the right
    # side of pairs (i<=b, b)
    left = F.transform(F.sequence(F.col("b"), F.lit(nb - 1)), lambda j: F.struct(
        F.col("b").alias("bi"), j.alias("bj"), F.lit(0).alias("side")))
    right = F.transform(F.sequence(F.lit(0), F.col("b")), lambda i: F.struct(
        i.alias("bi"), F.col("b").alias("bj"), F.lit(1).alias("side")))
    rows = b.select(F.explode(F.concat(left, right)).alias("p"), "id", "v").select("p.*", "id", "v")
    return rows.groupBy("bi", "bj"), n


def cosine_edges_of(unit: DataFrame, ids: DataFrame, threshold: float,
                    block_rows: int | None = None) -> DataFrame:
    """(mid, rid, r): those rows of ``cosine_edges`` whose ``mid`` is in ``ids``
    (id), by a product of their vectors with all, never of all with all.
    ``unit``: ``unit_vectors``, settled, as every call reads them."""
    asked = _settled(unit.join(ids.select("id").distinct(), "id", "left_semi"))
    n, dim = unit.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    nl, nr = plan_pair_blocks(asked.count(), n, _slots(unit), _self_block_rows(block_rows, dim))
    left = asked.select(block_of("id", nl).alias("bl"), F.explode(F.sequence(F.lit(0), F.lit(nr - 1))).alias("br"),
                        F.lit(0).alias("side"), "id", "v")
    right = unit.select(F.explode(F.sequence(F.lit(0), F.lit(nl - 1))).alias("bl"), block_of("id", nr).alias("br"),
                        F.lit(1).alias("side"), "id", "v")
    return left.unionByName(right).groupBy("bl", "br").applyInPandas(
        _cosine_rows_fn(threshold), "mid int, rid int, r double")


def _best_of_rows(s: np.ndarray, kk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``kk`` largest scores, the leftmost of
    equal ones; -inf never counts."""
    n = s.shape[1]
    kk = np.minimum(kk, n)
    most = int(kk.max(initial=0))
    if most == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    top = -np.sort(-np.partition(s, n - most, axis=1)[:, n - most:], axis=1)
    kth = np.where(kk > 0, top[np.arange(len(s)), np.maximum(kk, 1) - 1], np.inf)[:, None]
    above, ties = s > kth, s == kth
    room = kk - above.sum(axis=1)
    keep = above | (ties & (np.cumsum(ties, axis=1) <= room[:, None]))
    return np.nonzero(keep & (s > -np.inf))


def _plain_best(lm: np.ndarray, rm: np.ndarray, kk: np.ndarray, floor: np.ndarray) -> Iterator[tuple]:
    """Per row chunk the left and right places and scores of each row's best ``kk`` from ``floor`` on."""
    for lo, hi in _chunks(len(lm), len(rm)):
        s = lm[lo:hi] @ rm.T
        s = np.where(s >= floor[lo:hi, None], s, -np.inf)   # NaN never counts
        li, ri = _best_of_rows(s, kk[lo:hi])
        yield lo + li, ri, s[li, ri]


def _products_of(lm: np.ndarray, rm: np.ndarray, li: np.ndarray, ri: np.ndarray, step: int = 1 << 15) -> np.ndarray:
    return np.concatenate([np.zeros(0)] + [np.einsum("ij,ij->i", lm[li[a:a + step]], rm[ri[a:a + step]])
                                           for a in range(0, len(li), step)])


def _hits(s: np.ndarray, least: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column where ``s`` reaches its row's ``least``; few do, so eight
    cells are looked at at once."""
    np.greater_equal(s, least[:, None], out=mask)
    flat = mask.ravel()
    eights = len(flat) // 8
    some = np.flatnonzero(flat[:eights * 8].view(np.uint64) != 0)
    cells = (some[:, None] * 8 + np.arange(8)).ravel()
    if len(flat) % 8:
        cells = np.concatenate([cells, np.arange(eights * 8, len(flat))])
    return np.divmod(cells[flat[cells]], s.shape[1])


def _sieved_tile(lm: np.ndarray, rm: np.ndarray, a: np.ndarray, b: np.ndarray, scale: np.ndarray,
                 kk: np.ndarray, floor: np.ndarray, room: tuple) -> tuple | None:
    """As ``_plain_best`` for one row tile, in the buffers ``room``; ``a``, ``b`` are its vectors in
    single precision, of length 1 at most, whose products times ``scale`` are
    the scores.  A product there is off by less than ``err``, so only those
    that may still reach the row's ``kk``-th best so far are made in doubles.
    None if these are too many (equal scores)."""
    n, err = len(rm), (lm.shape[1] + 8) * 2.0 ** -23
    li, ri, sc = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    kth, lo, hi = floor.copy(), 0, min(n, max(2 * SIEVE_TILE[1], 4 * int(kk.max(initial=0))))
    most = max(SIEVE_MOST, 4 * int(kk.sum()))
    while lo < n:
        least, found, count = kth / scale - err, [], 0
        open_rows = np.flatnonzero(least == -np.inf)
        if len(open_rows) and hi - lo > kk[open_rows].max():
            s = a[open_rows] @ b[lo:hi].T
            at = (hi - lo) - np.maximum(kk[open_rows], 1)
            s.sort(axis=1)
            least[open_rows] = s[np.arange(len(s)), at] - 2 * err
        least = least.astype(np.float32)
        for c in range(lo, hi, SIEVE_TILE[1]):
            d = min(hi, c + SIEVE_TILE[1])
            cells = len(a) * (d - c)
            x, y = _hits(np.matmul(a, b[c:d].T, out=room[0][:cells].reshape(len(a), d - c)), least,
                         room[1][:cells].reshape(len(a), d - c))
            found.append((x, y + c))
            count += len(x)
            if count > most:
                return None
        x, y = (np.concatenate(z) for z in zip(*found))
        s = _products_of(lm, rm, x, y)
        x, y, s = (z[s >= kth[x]] for z in (x, y, s))
        li, ri, sc = np.concatenate([li, x]), np.concatenate([ri, y]), np.concatenate([sc, s])
        order = np.lexsort((ri, -sc, li))
        li, ri, sc = li[order], ri[order], sc[order]
        begin = np.searchsorted(li, np.arange(len(lm) + 1))
        keep = np.arange(len(li)) - begin[li] < kk[li]
        li, ri, sc = li[keep], ri[keep], sc[keep]
        end = np.searchsorted(li, np.arange(len(lm)), side="right")
        full = (np.bincount(li, minlength=len(lm)) >= kk) & (kk > 0)
        kth[full] = sc[end[full] - 1]
        lo, hi = hi, min(n, 2 * hi)
    return li, ri, sc


def _best_products(lm: np.ndarray, rm: np.ndarray, kk: np.ndarray, floor: np.ndarray) -> Iterator[tuple]:
    """As ``_plain_best``, by a sieve in single precision where the norms allow it."""
    norm, top = np.sqrt(np.einsum("ij,ij->i", lm, lm)), np.sqrt(np.einsum("ij,ij->i", rm, rm).max(initial=0))
    usual = (norm > 1e-100) & (norm < 1e100) & (1e-100 < top < 1e100)   # not so for NaN either
    if len(rm) < SIEVE_FROM:
        usual[:] = False
    rest = [np.flatnonzero(~usual)]
    rows = np.flatnonzero(usual)
    b = (rm / top).astype(np.float32) if len(rows) else None
    room = tuple(np.empty(SIEVE_TILE[0] * SIEVE_TILE[1], t) for t in (np.float32, bool))
    for lo in range(0, len(rows), SIEVE_TILE[0]):
        i = rows[lo:lo + SIEVE_TILE[0]]
        got = _sieved_tile(lm[i], rm, (lm[i] / norm[i, None]).astype(np.float32), b, norm[i] * top, kk[i], floor[i], room)
        if got is None:
            rest.append(i)
        else:
            yield i[got[0]], got[1], got[2]
    i = np.concatenate(rest)
    for li, ri, s in _plain_best(lm[i], rm, kk[i], floor[i]):
        yield i[li], ri, s


def _gathered(frames: Iterator[pd.DataFrame], columns: list[str]) -> tuple:
    """Ids, vectors and further columns of a group's left rows, and ids and
    vectors of its right rows by ascending id.  A frame's vectors become a matrix
    as it arrives and go as they reach their place, so that a group is held once."""
    rest, parts = ([], []), ([], [])
    for frame in frames:
        for side in (0, 1):
            own = frame[frame["side"] == side]
            if len(own):
                rest[side].append(own[["id", *columns]])
                parts[side].append(_matrix(own["v"]))
    out = []
    for side in (0, 1):
        if not parts[side]:
            return ()
        rows = pd.concat(rest[side], ignore_index=True)
        order = rows["id"].argsort(kind="stable").to_numpy() if side else np.arange(len(rows))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        vectors, end = np.empty((len(rows), parts[side][0].shape[1])), len(rows)
        while parts[side]:
            last = parts[side].pop()
            vectors[place[end - len(last):end]] = last
            end -= len(last)
        out += [rows.iloc[order], vectors]
    return tuple(out)


def _topk_fn(k: int, extra_col: str | None, floor_col: str | None = None):
    columns = [c for c in (extra_col, floor_col) if c]

    def fn(key, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = _gathered(frames, columns)
        if group:
            left, lm, right, rm = group        # equal scores: the smallest right id first
            lid, rid = left["id"].to_numpy(), right["id"].to_numpy()
            more = (left[extra_col].fillna(0).to_numpy().astype(np.int64)
                    if extra_col is not None else np.zeros(len(lid), np.int64))
            floor = left[floor_col].to_numpy() if floor_col is not None else np.full(len(lid), -np.inf)
            for li, ri, s in _best_products(lm, rm, k + more, floor):
                yield pd.DataFrame({"uid": lid[li].astype(np.int32), "rid": rid[ri].astype(np.int32), "r": s})
    fn.__annotations__ = {"key": tuple, "frames": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return fn


def _block_rows(lv: DataFrame, rv: DataFrame) -> tuple[int, int, int]:
    """Rows of both sides, and how many fill BLOCK_BYTES."""
    wide = F.max(F.size("v")).alias("d"), F.count(F.lit(1)).alias("n")
    left, right = lv.agg(*wide).first(), rv.withColumnRenamed("v_r", "v").agg(*wide).first()
    return left.n, right.n, max(1, BLOCK_BYTES // (8 * max(1, left.d or 1, right.d or 1)))


def top_k_candidates(left: DataFrame, right: DataFrame, k: int, block_rows: int | None = None,
                     left_id: str = "id", right_id: str = "id", vec_col: str = "features",
                     extra_k: str | None = None, unique_ids: bool = False, prune: bool | None = None) -> DataFrame:
    """(uid, rid, r): a superset of each left row's ``k`` best right rows by
    dot product - exactly the best k of every block pair (r desc, rid asc),
    so at most k rows per left row and right block.

    ``extra_k`` names an optional left column holding a per-row number of
    additional rows to keep (exact over-fetch before an exclusion).
    ``block_rows`` (default: by bytes) caps a block's rows: every left row is
    shipped once a right block and the other way round, so the larger the blocks,
    the fewer the copies.  ``prune``
    (default: by the right side's size) ships a left row only to the blocks
    whose largest norm may still give it a better score.
    """
    lv = left.select(F.col(left_id).alias("id"), F.col(vec_col).alias("v"))
    rv = right.select(F.col(right_id).alias("id_r"), F.col(vec_col).alias("v_r"))
    if not unique_ids:
        lv, rv = one_per_id(lv, "id", "v"), one_per_id(rv, "id_r", "v_r")
    if extra_k:  # the per-row extra count is a function of the id
        extra = left.groupBy(F.col(left_id).alias("id")).agg(F.max(extra_k).alias(extra_k))
        lv = lv.join(extra, "id")
    lv, rv = _settled(lv), _settled(rv)
    n_left, n_right, most = _block_rows(lv, rv)
    block_rows = block_rows or most
    nbl, nbr = plan_pair_blocks(n_left, n_right, _slots(lv), block_rows)
    if n_right >= PRUNE_FROM if prune is None else prune:
        from ratingflow.operators.pruned import falling_norms
        return falling_norms(lv, rv, k, extra_k, nbl, nbr, block_rows, n_right).candidates()
    lb = lv.select(block_of("id", nbl).alias("bl"),
                   F.explode(F.sequence(F.lit(0), F.lit(nbr - 1))).alias("br"), "*")
    return best_of_blocks(lb, rv.withColumn("br", block_of("id_r", nbr)), nbl, k, extra_k)


def best_of_blocks(left: DataFrame, right: DataFrame, nbl: int, k: int, extra_k: str | None = None,
                   floor: str | None = None) -> DataFrame:
    """(uid, rid, r): the best ``k`` of every block pair; ``left`` (bl, br, id,
    v) is dealt out already, ``right`` (br, id_r, v_r) goes to all ``nbl`` left
    blocks.  ``floor`` names a left column: scores below it are left out."""
    columns = [c for c in (extra_k, floor) if c]
    lrows = left.select("bl", "br", F.lit(0).alias("side"), F.col("id").cast("long").alias("id"), "v", *columns)
    rrows = right.select(F.explode(F.sequence(F.lit(0), F.lit(nbl - 1))).alias("bl"), "br", F.lit(1).alias("side"),
                         F.col("id_r").cast("long").alias("id"), F.col("v_r").alias("v"),
                         *(F.lit(None).cast(dict(left.dtypes)[c]).alias(c) for c in columns))
    return lrows.unionByName(rrows).groupBy("bl", "br").applyInPandas(
        _topk_fn(k, extra_k, floor), "uid int, rid int, r double")


def top_k_products(left: DataFrame, right: DataFrame, k: int, block_rows: int | None = None,
                   left_id: str = "id", right_id: str = "id",
                   vec_col: str = "features", unique_ids: bool = False, prune: bool | None = None) -> DataFrame:
    """(uid, rid, r, pos): for every left row the ``k`` right rows with the
    largest dot product (r desc, rid asc).  At most nr * k candidates per
    row reach the final ranking (none to merge when nr = 1)."""
    cand = top_k_candidates(left, right, k, block_rows, left_id, right_id, vec_col,
                            unique_ids=unique_ids, prune=prune)
    return top_k(cand, ["uid"], [F.col("r").desc(), F.col("rid").asc()], k)


def top_k_products_excluding(left: DataFrame, right: DataFrame, exclude: DataFrame, k: int,
                             block_rows: int | None = None, left_id: str = "id",
                             right_id: str = "id", vec_col: str = "features",
                             unique_ids: bool = False, prune: bool | None = None) -> DataFrame:
    """As ``top_k_products`` but skipping (uid, rid) pairs in ``exclude``.

    Exact: a row with c excluded partners keeps its best k + c per block
    pair, which always contains its best k non-excluded partners; the anti
    join then removes the excluded ones.  c comes from a partial
    aggregate, never from collecting a user's list.
    """
    ex = (exclude.select("uid", "rid").distinct()
          .join(right.select(F.col(right_id).alias("rid")), "rid", "left_semi"))
    counts = ex.groupBy(F.col("uid").alias("_cuid")).agg(F.count(F.lit(1)).alias("_extra"))
    lx = left.join(counts, left[left_id] == counts["_cuid"], "left").drop("_cuid") \
        .fillna(0, subset=["_extra"])
    cand = top_k_candidates(lx, right, k, block_rows, left_id, right_id, vec_col, extra_k="_extra",
                            unique_ids=unique_ids, prune=prune)
    kept = cand.join(ex, ["uid", "rid"], "left_anti")
    return top_k(kept, ["uid"], [F.col("r").desc(), F.col("rid").asc()], k)
