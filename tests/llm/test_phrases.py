import hashlib
import random

import numpy as np

from ratingflow.llm import phrases, queries
from ratingflow.llm.common import mix
from tests.llm.helpers import SF, frame, texts

MASK = (1 << 64) - 1


def mixed(v):
    return int(mix(np.array([v & MASK], dtype=np.uint64))[0])


def slow_labels(x):
    for _ in range(4):
        out = []
        for i, v in enumerate(x):
            if i == 0:
                out.append(v & 1)
            else:
                low = ((v ^ x[i - 1]) & -(v ^ x[i - 1])).bit_length() - 1
                out.append(2 * low + (v >> low & 1))
        x = out
    return x


def slow_level(x):
    merged, i = [], 0
    while i < len(x):
        j = i
        while j < len(x) and x[j] == x[i]:
            j += 1
        merged.append(x[i] if j - i == 1 else mixed(x[i] * 0x9E3779B97F4A7C15 + (j - i)))
        i = j
    label = slow_labels(merged)
    starts = [i for i in range(len(merged))
              if i == 0 or i < len(merged) - 1 and label[i] > label[i - 1] and label[i] > label[i + 1]]
    return [mixed(sum(mixed(merged[a + k]) * pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(b - a)) + b - a)
            for a, b in zip(starts, [*starts[1:], len(merged)])]


def slow_sketch(text, size=phrases.SIZE):
    x, found = [ord(c) for c in text], set()
    for level in range(1, phrases.LAST + 1):
        x = slow_level(x) if x else x
        if level >= phrases.FIRST:
            found |= {mixed(v + level) >> 32 for v in x}
    return sorted(found)[:size]


def test_sketches_equal_a_plain_parse():
    rng = random.Random(1)
    some = ["", "a", "aa", "aaaaaaaa", "ab", "abc", "🎉é" * 40]
    some += ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 3000))) for _ in range(25)]
    assert [s.tolist() for s in phrases.sketches(some)] == [slow_sketch(t) for t in some]


def test_neighbours_keep_different_labels():
    rng = np.random.default_rng(3)
    for kind in (np.uint32, np.uint64):
        x = rng.integers(0, 1 << 21, 5000).astype(kind)
        x = x[np.append(True, x[1:] != x[:-1])]
        label = phrases.coin_labels(x, np.array([0, 1000, 1001]))
        assert label.max() < 6
        inside = np.ones(len(x) - 1, bool)
        inside[[999, 1000]] = False
        assert (label[1:] != label[:-1])[inside].all()


def test_equal_substrings_share_inner_phrases_wherever_they_stand():
    rng = random.Random(5)
    part = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    one, other = ("".join(rng.choice("abcdefgh ") for _ in range(n)) + part for n in (137, 60))
    a, b, c = phrases.sketches([one, other, "".join(rng.choice("abcdefgh ") for _ in range(4000))], size=1 << 20)
    assert phrases.likeness(a, b, 1 << 20) > 0.9 and phrases.likeness(a, c, 1 << 20) < 0.05


def test_query_equals_brute_force(spark):
    rows = texts(spark)
    got = {r.doc_id: r for r in queries.op9_fingerprints(spark, SF).collect()}
    assert len(got) == len(rows)
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        own, changed, after = phrases.sketches([t]) + phrases.sketches([edited]) + phrases.sketches([nxt])
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (phrases.to_hex(own), phrases.to_hex(changed))
        assert (r.near_edited, r.near_next) == (phrases.likeness(own, changed), phrases.likeness(own, after))


def test_awkward_rows_and_range_borders(spark):
    rows = [(None, "no id"), (5, "five five five"), (5, "five five five"), (-3, None), (0, ""), (9, "x" * 50_000),
            (12, "tail")]
    order = [(None, "no id"), (-3, ""), (0, ""), (5, "five five five"), (5, "five five five"), (9, "x" * 50_000),
             (12, "tail")]
    want = []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        want.append((i is not None, i or 0, hashlib.sha256(phrases.edit(t, nxt).encode()).hexdigest()))
    for ranges in (1, 3, 16):
        got = phrases.edited_fingerprints(frame(spark, rows), ranges=ranges).collect()
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.edited_sha256) for r in got) == sorted(want)
    by_id = {r.doc_id: r for r in got}
    assert by_id[-3].fingerprint == "" and by_id[-3].near_next == 1.0 and by_id[0].near_next == 0.0
    assert len(phrases.edited_fingerprints(frame(spark, rows[:1])).collect()) == 1
    assert phrases.edited_fingerprints(frame(spark, [])).collect() == []
    assert phrases.fingerprints(frame(spark, [])).collect() == []


def test_one_id_on_a_third_of_all_rows(spark):
    """Even ranges, and each document compared with the one after it."""
    from pyspark.sql import functions as F
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcde ") for _ in range(rng.randrange(20, 200)))
    rows = [(i, word()) for i in range(400)] + [(150, word()) for _ in range(100)] + [(150, "the same text " * 8)] * 100
    rows += [(77, "long " * 4000)]
    ranges = 12
    dealt = phrases.with_next_document(frame(spark, rows).repartition(5), ranges)
    sizes = {r.target: (r.n, r.bytes) for r in dealt.where("guest = 0").groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(F.octet_length("text")) - F.max(F.octet_length("text"))).alias("bytes")).collect()}
    total = sum(len(t) for _, t in rows)
    assert sum(n for n, _ in sizes.values()) == len(rows)
    # besides its longest text, which can't be split
    assert all(b < 2 * total / ranges for _, b in sizes.values())
    assert dealt.where("guest = 1").count() == len(sizes)
    # the order: ids, and within an id any, equal texts together
    parts = {}
    for r in dealt.rdd.mapPartitionsWithIndex(lambda p, it: ((p, r.target, r.guest, r.doc_id, r.text) for r in it)).collect():
        parts.setdefault(r[1], []).append(r[2:])
    order = [r for t in sorted(parts) for r in parts[t] if r[0] == 0]
    assert sorted(order) == sorted((0, *r) for r in rows) and [r[1] for r in order] == sorted(r[0] for r in rows)
    chain = [p for t in sorted(parts) for p in parts[t]]
    assert all(chain[i][1:] == chain[i + 1][1:] for i in range(len(chain) - 1) if chain[i][0] == 1)
    got = sorted((r.doc_id, r.edited_sha256) for r in phrases.edited_fingerprints(frame(spark, rows), ranges=ranges).collect())
    texts_ = [r[2] for r in order]
    assert got == sorted((r[1], hashlib.sha256(phrases.edit(t, n).encode()).hexdigest())
                         for r, t, n in zip(order, texts_, texts_[1:] + texts_[:1]))
