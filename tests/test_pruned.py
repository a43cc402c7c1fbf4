"""Pruned vector products, joins and places with hot keys: the same results, less work."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingflow.operators import blocked, places, pruned
from ratingflow.operators.hubs import heavy_keys, hub_join
from ratingflow.operators.similarity import nest_edges

VEC = "mid int, features array<double>"


def vectors(spark, m):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], VEC)


def cosines(m, t):
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = u @ u.T
    return {(i, j): s[i, j] for i in range(len(m)) for j in range(len(m)) if i != j and s[i, j] > t}


@pytest.mark.parametrize("kind,t", [("clusters", 0.95), ("random", 0.2), ("line", 0.9999), ("one", 0.99), ("negative", -0.5)])
def test_cosine_edges_are_the_same(spark, kind, t):
    rng = np.random.default_rng(len(kind))
    m = rng.normal(size=(240, 8))
    if kind == "clusters":
        m = np.eye(8)[rng.integers(0, 8, 240)] + rng.normal(size=(240, 8)) * 0.08
    elif kind == "line":
        a = np.linspace(0, 3, 240)
        m = np.stack([np.cos(a), np.sin(a)], axis=1)
    elif kind == "one":
        m = np.ones((240, 3)) * rng.random((240, 1)) + rng.random((240, 1)) * 1e-12
    got = {(r.mid, r.rid): r.r for r in blocked.cosine_edges(vectors(spark, m), t, prune=True, nb=9).collect()}
    want = cosines(m, t)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_far_clusters_are_left_out_and_counted(spark):
    rng = np.random.default_rng(5)
    m = np.eye(10)[np.arange(400) % 10] + rng.normal(size=(400, 10)) * 0.02
    unit = blocked.unit_vectors(vectors(spark, m), "mid", "features").checkpoint()
    found = pruned.near_clusters(unit, 0.9, nb=10, n=400)
    report = found.report().first()
    assert report.cells == 400 * 399 // 2 and report.cells_skipped > 0.85 * report.cells
    assert report.pairs_skipped > 0.7 * report.pairs
    # every row once for each block pair it is in, both sides
    rows = found.rows()
    assert rows.groupBy("bi", "si", "bj", "sj").count().count() == report.pairs - report.pairs_skipped
    assert pruned.near_clusters(unit, -1.1, nb=10, n=400).report().first().pairs_skipped == 0


def test_empty_and_single_vectors(spark):
    for m in (np.zeros((0, 3)), np.ones((1, 3)), np.zeros((4, 3))):
        assert blocked.cosine_edges(vectors(spark, m), 0.1, prune=True).collect() == []


def best(users, items, k, exclude=()):
    s = users @ items.T
    out = []
    for u in range(len(users)):
        order = [i for i in sorted(range(len(items)), key=lambda i: (-s[u, i], i)) if (u, i) not in exclude]
        out += [(u, i) for i in order[:k]]
    return out


@pytest.mark.parametrize("kind", ["falling", "equal", "ties", "zero users"])
def test_top_k_is_the_same(spark, kind):
    rng = np.random.default_rng(3)
    users, items = rng.integers(-3, 4, (30, 4)).astype(float), rng.integers(-3, 4, (500, 4)).astype(float)
    if kind == "falling":
        items = items / np.arange(1, 501)[:, None]
    elif kind == "equal":
        items = rng.normal(size=(500, 4))
        items /= np.linalg.norm(items, axis=1, keepdims=True)
    elif kind == "zero users":
        users[:10] = 0
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(users)], "uid int, features array<double>")
    got = blocked.top_k_products(left, vectors(spark, items), 7, left_id="uid", right_id="mid", prune=True, block_rows=50)
    assert sorted((r.uid, r.pos, r.rid) for r in got.collect()) == sorted(
        (u, p % 7 + 1, i) for p, (u, i) in enumerate(best(users, items, 7)))
    banned = {(u, i) for u in range(0, 30, 3) for i in rng.integers(0, 500, 40).tolist()} | {(2, i) for _, i in best(users[2:3], items, 25)}
    ex = spark.createDataFrame(sorted(banned), "uid int, rid int")
    got = blocked.top_k_products_excluding(left, vectors(spark, items), ex, 7, left_id="uid", right_id="mid", prune=True)
    assert sorted((r.uid, r.rid) for r in got.collect()) == sorted(best(users, items, 7, banned))


def test_users_go_to_the_blocks_that_may_better_their_lists(spark):
    rng = np.random.default_rng(8)
    items = rng.normal(size=(2000, 6)) / np.arange(1, 2001)[:, None]
    right = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "id_r int, v_r array<double>")
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 6)))], "id int, v array<double>")
    found = pruned.falling_norms(left, right, 5, None, 2, 10, 1 << 16, 2000)
    report = found.report().first()
    assert report.cells == 100_000 and report.cells_multiplied < 0.3 * report.cells
    assert found.head + sum(found.sizes) == 2000


def test_places_and_pages_of_a_hot_group(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") % 50).cast("int")).alias("mid"),
                                    F.col("id").cast("int").alias("rid"), ((F.col("id") * 37) % 11 / 10).alias("r"))
    order = [F.col("r").desc(), F.col("rid").asc()]
    got = places.placed(rows, ["mid"], order, ranges=12)
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r.mid, -r.r, r.rid)):
        want.setdefault(r.mid, []).append(r.rid)
    assert {(r.mid, r.pos): r.rid for r in got.collect()} == {(m, i + 1): x for m, xs in want.items() for i, x in enumerate(xs)}
    assert got.columns == ["mid", "rid", "r", "pos"]
    pages = nest_edges(rows, page_rows=100).collect()
    assert max(len(p.recs) for p in pages) == 100 and len([p for p in pages if p.mid == 7]) >= 20
    lists = {}
    for p in sorted(pages, key=lambda p: (p.mid, p.page)):
        lists.setdefault(p.mid, []).extend(x.rid for x in p.recs)
    assert lists == want
    # the sorted ranges share the hot group
    sizes = rows.repartitionByRange(12, "mid", *order).withColumn("p", F.spark_partition_id()).where("mid = 7").groupBy("p").count()
    assert sizes.count() >= 3
    none = spark.createDataFrame([], "mid int, rid int, r double")
    assert places.placed(none, ["mid"], order).count() == 0 and nest_edges(none, page_rows=5).count() == 0
    odd = spark.createDataFrame([(None, 1, 0.5), (None, 2, None), (3, None, 0.1)], "mid int, rid int, r double")
    assert sorted((str(r.mid), str(r.rid), r.pos) for r in places.placed(odd, ["mid"], order).collect()) == [
        ("3", "None", 1), ("None", "1", 1), ("None", "2", 2)]


def test_hub_join_spreads_a_hot_key_without_adaptive_execution(spark):
    left = spark.range(3000).select(F.col("id").cast("int").alias("uid"),
                                    F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") % 500).cast("int")).alias("mid"))
    right = spark.range(1000).select((F.col("id") % 400).cast("int").alias("mid"), F.col("id").cast("int").alias("rid"))
    heavy = dict(heavy_keys(left, "mid", 16))
    assert set(heavy) == {7} and heavy[7] >= 5
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        size = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        plain, spread = left.join(right, "mid"), hub_join(left, right, "mid", "uid")
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, spread.collect()))
        assert plain.columns == spread.columns
        total = plain.count()
        assert size(plain) > total / 3 and size(spread) < total / 5
        assert hub_join(left.where("uid < 0"), right, "mid", "uid").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_bits_of_rated_movies(spark):
    from ratingflow.operators.recommend import in_bitmaps, rated_bitmaps
    mids = [1, 7, 8, 32767, 32768, 32769, 40000, 2_000_000_000, 0, -5]
    rows = spark.createDataFrame([(1, m) for m in mids] * 2 + [(2, 5), (2, None)], "uid int, mid int")
    bits = rated_bitmaps(rows)
    assert {r.uid: r.n for r in bits.collect()} == {1: len(mids), 2: 1}
    asked = [*mids, 2, 9, 32766, 32770, 39999, 2_000_000_001, -4, 65536, None]
    ask = spark.createDataFrame([(u, m) for u in (1, 2, 3) for m in asked], "uid int, rid int")
    got = ask.join(bits, "uid", "left").select("uid", "rid", in_bitmaps("seen", "rid").alias("hit")).collect()
    want = {(1, m) for m in mids} | {(2, 5)}
    assert {(r.uid, r.rid) for r in got if r.hit} == want & {(u, m) for u in (1, 2, 3) for m in asked}
    few = rated_bitmaps(rows, spark.createDataFrame([(2,), (9,)], "uid int"))
    assert [r.uid for r in few.collect()] == [2]
