import random

import numpy as np
import xxhash

from ratingflow.llm import queries, simhash
from tests.llm.helpers import SF, frame, texts, words


def reference_fp(text, n=4):
    own = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words(text)]
    if not own:
        return 0
    shingles = [b" ".join(own[i:i + n]) for i in range(max(1, len(own) - n + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def reference_groups(fps, bits):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    value = np.array([fps[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(value[k + 1:] ^ value[k]) <= bits) + k + 1:
            a, b = find(i), find(ids[j])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark):
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id, len(r.fingerprint))
           for r in queries.op1_simhash(spark, SF).collect()}
    fps = {i: reference_fp(t) for i, t in texts(spark)}
    groups = reference_groups(fps, 4)
    assert got == {i: (fps[i], groups[i], 16) for i in fps}


def planted(seed, families, size):
    """Fingerprints in chains and stars of up to four differing bits."""
    rng = random.Random(seed)
    out = set()
    for _ in range(families):
        x = rng.getrandbits(64)
        for _ in range(size):
            out.add(x)
            for _ in range(rng.randrange(0, 5)):
                x ^= 1 << rng.randrange(64)
    return sorted(out)


def test_links_connect_every_group_even_in_split_buckets(spark):
    values = planted(3, 12, 40)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    fps = spark.createDataFrame(signed, "fp long")
    want = reference_groups({v: v for v in values}, 4)
    groups = {}
    for v, r in want.items():
        groups.setdefault(r, set()).add(v)
    # small buckets, buckets dealt out as pairs of blocks, and long ones in one task
    for bucket_rows in (4, 1 << 15):
        found = simhash.components(simhash.links(fps, 4, bucket_rows, pair_rows=4)).collect()
        by_root = {}
        for r in found:
            by_root.setdefault(r.root, set()).add(r.node % (1 << 64))
        assert all(root % (1 << 64) in own for root, own in by_root.items())
        assert sorted(map(sorted, by_root.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_segments_leave_one_with_at_most_one_difference():
    for bits in range(0, 8):
        parts = simhash.segments(bits)
        assert sum(w for _, w in parts) == 64 and len(parts) == bits // 2 + 1
        assert bits // len(parts) <= 1


def test_long_chain_of_links_is_one_group(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_bit_counts_match_plain_counting():
    rng = np.random.default_rng(1)
    for n in (1, 254, 255, 256, 2000):
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        assert simhash.bit_counts(x).tolist() == [int(((x >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]


def test_awkward_rows(spark):
    long = "word " * 200_000
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (4, "One two"), (5, "ONE TWO"), (None, "one two"),
            (6, long), (7, long + " tail"), (8, "é É"), (9, "é É")]
    got = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(frame(spark, rows)).collect()]
    assert len(got) == len(rows)
    by_id = {}
    for i, fp, c in got:
        by_id.setdefault(i, []).append((fp % (1 << 64), c))
    assert by_id[1] == by_id[2] == by_id[3] == [(0, 1)]
    assert by_id[4] == [(reference_fp("one two"), 4)] * 2 and by_id[None] == by_id[5] == by_id[4][:1]
    assert by_id[6][0][0] == reference_fp(long) and by_id[7][0][1] == 6
    assert by_id[8] == by_id[9] and by_id[8][0][1] == 8
    kept = simhash.representatives(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    # a group whose smallest id is 4 keeps that row once
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 6, 8]


def test_only_near_copies_go_of_rows_that_share_an_id(spark):
    lone = [(i, f"a text of its own {n} " + " ".join(f"w{n}x{k}" for k in range(40)))
            for n, i in enumerate([None, None, None, 5, 5, 6])]
    docs = frame(spark, lone + [(5, lone[0][1]), (None, lone[5][1]), (6, lone[5][1])])
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    want = [(5, lone[0][1]), *lone[1:]]
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, want))


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert simhash.representatives(frame(spark, [])).collect() == []
