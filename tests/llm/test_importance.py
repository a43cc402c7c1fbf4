import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ratingflow.llm import importance, queries
from tests.llm.helpers import SF, frame, texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def crcs(text, order=2):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, percent=25, order=2, buckets=10000, min_words=20, seed=7):
    def counts(all_texts):
        out = [0] * buckets
        for t in all_texts:
            for c in crcs(t, order):
                out[c % buckets] += 1
        return out
    s, t = counts(x for _, x in docs), counts(target)
    a, b = sum(s) + buckets, sum(t) + buckets
    gain = [math.floor(1000 * math.log((y + 1) * a / ((x + 1) * b))) for x, y in zip(s, t)]
    rows = []
    for doc, text in docs:
        found = [gain[c % buckets] for c in crcs(text, order)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None, len(words(text)) >= min_words])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for n, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = n
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_query_equals_brute_force(spark):
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op13_importance(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(texts(spark), target)


AWKWARD = [(1, None), (2, ""), (3, " \t--!"), (4, "OneÉ two-THREE 4\x00five 中文  x" * 4), (5, "a"), (5, "b " * 30),
           (5, "b " * 30), (5, "b " * 31), (None, "c d " * 15), (None, "e " * 25), (7, "w" * 3000 + " " + "v" * 200 + " u" * 25),
           (-8, "same words here " * 10), (9, "same words here " * 10), (10, "\n".join("abcdefghijklmnopqrstuvwxyz"))]


@pytest.mark.parametrize("percent,order", [(25, 2), (100, 3), (50, 1), (0, 2)])
def test_awkward_rows(spark, percent, order):
    target = [(1, "two three"), (2, None), (3, "same words")]
    got = importance.resample(frame(spark, AWKWARD).repartition(4), frame(spark, target), percent=percent, order=order, buckets=97)
    got = sorted((tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)
    assert got == plain(AWKWARD, [t for _, t in target], percent, order, 97)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert importance.resample(none, none).collect() == []
    rows = [(i, "b c " * 20) for i in range(8)]
    got = importance.resample(frame(spark, rows), none)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()) \
        == sorted(plain(rows, []), key=lambda r: r[0])


@pytest.mark.parametrize("order", [1, 2, 4])
def test_crcs_of_prefixes_over_slices(monkeypatch, order):
    monkeypatch.setattr(importance, "SLICE", 50)
    rng = np.random.default_rng(3)
    docs = [" ".join("".join(chr(rng.choice([97, 98, 233, 0x4e2d])) for _ in range(rng.choice([1, 3, 9, 140, 300])))
                     for _ in range(rng.integers(0, 40))) for _ in range(25)]
    got = [[] for _ in docs]
    for _, who, what in importance.features(pa.array(docs), order, importance.Shift()):
        for d, c in zip(who.tolist(), what.tolist()):
            got[d].append(c)
    assert [sorted(g) for g in got] == [sorted(crcs(t, order)) for t in docs]


def test_ranks_count_equal_rows_apart(spark):
    from pyspark.sql import functions as F
    rows = spark.range(3000).select((F.col("id") % 3).alias("v"))
    got = importance.ranked(rows, F.col("v").desc()).collect()
    assert sorted(r.rank for r in got) == list(range(1, 3001))
    assert [r.v for r in sorted(got, key=lambda r: r.rank)] == [2] * 1000 + [1] * 1000 + [0] * 1000
