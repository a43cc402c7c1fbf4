import hashlib
import math
import random

import numpy as np
import pytest

from ratingflow.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, x array<int>, far string, code string, error long, of int, n int"


def frame(spark, rows):
    rows = [(i, v and [x if x is None else float(x) for x in v], label) for i, v, label in rows]
    return spark.createDataFrame([(*r, [1], "f", "c", 2, 3, 4) for r in rows], SCHEMA)


def plain(rows, parts, entries, rounds, scale=256):
    """The same by exhaustive search in Python's integers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = next((len(v) for _, v, _ in kept if v and len(v) % parts == 0), 0)
    kept = [r for r in kept if len(r[1]) == size]
    width = size // parts
    cut = [[[math.floor(scale * float(np.float32(x))) for x in v[p * width:(p + 1) * width]] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for c in cut:
                held[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(h) for col in zip(*h)] if h else e for h, e in zip(held, books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for (i, _, label), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    total = {}
    for _, label, _, d in out:
        total[label] = total.get(label, 0) + d
    return sorted(((i, label, code, d, total[label], sha) for i, label, code, d in out), key=str)


def coded(spark, rows, **options):
    done = vector_codes.encode(frame(spark, rows), **options)
    return sorted((tuple(r)[:6] for r in done.collect()), key=str)


@pytest.mark.parametrize("kind", ["spread", "clustered", "ties"])
def test_equals_exhaustive_search(spark, kind):
    rng = random.Random(kind)
    draw = {"spread": lambda: rng.gauss(0, 0.2), "clustered": lambda: rng.choice([-1, 0, 1]) + rng.gauss(0, 0.01),
            "ties": lambda: rng.choice([0, 1 / 256, -1 / 256])}[kind]
    rows = [(i, [draw() for _ in range(12)], rng.choice([None, 1, 2])) for i in rng.sample(range(-100, 900), 150)]
    assert coded(spark, rows, parts=4, entries=16, rounds=2) == plain(rows, 4, 16, 2)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [nan, 1, 1, 1], 1), (3, [1, inf, 1, 1], 1), (4, [1, None, 1, 1], 1), (5, [], 1),
            (6, [1, 2, 3], 1), (7, [0.5, -0.001, 2, 3], None), (7, [0.5, -0.001, 2, 3], None), (7, [1, 0, 0, 0], 2),
            (None, [9, 9, 9, 9], 3), (8, [1, 2, 3, 4, 5, 6], 3), (-4, [0, 0, 0, 0], 3)]
    assert coded(spark, rows, parts=2, entries=3, rounds=2) == plain(rows, 2, 3, 2)
    assert len(coded(spark, rows, parts=2, entries=64, rounds=1)) == 5


def test_empty_tables(spark):
    for rows in ([], [(1, None, 2), (2, [], 3)]):
        done = vector_codes.encode(frame(spark, rows))
        assert done.collect() == [] and done.columns[:6] == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]


def test_huge_components_stay_whole_numbers(spark):
    rows = [(i, [3e38, -3e38] * 32, 1) for i in range(3)] + [(9, [-3e38, 3e38] * 32, 1)]
    got = coded(spark, rows, parts=16, entries=1, rounds=0)
    assert [r[3] for r in got] == [0, 0, 0, 64 * (2 * vector_codes.LIMIT) ** 2]


def test_bounds_prune_and_never_miss(spark):
    rng = np.random.default_rng(1)
    entries = rng.integers(-300, 300, (64, 4))
    x = np.concatenate([entries[rng.integers(0, 64, 2000)] + rng.integers(-9, 9, (2000, 4)), entries, entries + 1])
    pivots = vector_codes.pivots_of(entries)
    far = np.sqrt(vector_codes.squared(x[:, None], pivots)).astype(np.float32)
    index, best, done = vector_codes.nearest(x, far, entries, pivots)
    every = vector_codes.squared(x[:, None], entries)
    assert (best == every.min(1)).all() and (index == every.argmin(1)).all()
    assert done.mean() < 8                  # of 64


def test_distances_to_a_pivot_bound_large_numbers():
    rng = np.random.default_rng(2)
    entries = rng.integers(-vector_codes.LIMIT, vector_codes.LIMIT, (64, 4))
    x = np.concatenate([entries + rng.integers(-1, 2, (64, 4)), rng.integers(-vector_codes.LIMIT, vector_codes.LIMIT, (500, 4))])
    pivots = vector_codes.pivots_of(entries)
    far = np.sqrt(vector_codes.squared(x[:, None], pivots).astype(float)).astype(np.float32)
    index, best, _ = vector_codes.nearest(x, far, entries, pivots)
    every = vector_codes.squared(x[:, None], entries)
    assert (best == every.min(1)).all() and (index == every.argmin(1)).all()
