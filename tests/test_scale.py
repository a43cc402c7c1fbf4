"""What keeps the work of larger tables in bounds: rows, keys and ids that
small tables don't have."""

import numpy as np

from ratingflow.operators import blocked, pruned
from ratingflow.operators.recommend import in_bitmaps, rated_bitmaps
from ratingflow.operators.similarity import SimilarMovies, item_similarity


def embeddings(spark, folder, ids, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(size=64)], 0) for i in ids]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def test_falling_norms_of_large_ids(spark, tmp_path):
    from ratingflow.plans.queries import falling_vectors
    rows = falling_vectors(spark, embeddings(spark, tmp_path, [1, 46_340, 2_000_000_000])).collect()
    assert {r.mid for r in rows if 0 < max(map(abs, r.features)) < 4} == {1, 46_340, 2_000_000_000}


def test_hub_of_large_ids(spark, tmp_path):
    from ratingflow.plans.queries import similar_items_hub
    sf = embeddings(spark, tmp_path, range(30_000, 30_060))
    got = {r.mid: r for r in similar_items_hub(spark, sf).collect()}
    assert got[-1].top_rid > 30_000 * 100_000 and got[-1].n_similar > 0


def test_edges_of_asked_movies_are_those_of_the_whole_table(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)] + [(300, [0.0] * 4), (301, None)]
    v = spark.createDataFrame(rows + rows[:20], "mid int, features array<double>")
    similar = SimilarMovies(v, 0.6)
    asked = spark.createDataFrame([(m,) for m in (3, 3, 17, 299, 300, 999, None)], "mid int")
    whole = item_similarity(v, 0.6).where("mid in (3, 17, 299)")
    key = lambda r: (r.mid, r.rid, round(r.r, 9))
    want = sorted(map(key, whole.collect()))
    assert want and sorted(map(key, similar.edges_of(asked).collect())) == want
    ranked = similar.of_movies(asked).where("mid = 3").orderBy("pos").collect()
    assert [r.pos for r in ranked] == list(range(1, len(ranked) + 1)) and [r.r for r in ranked] == sorted((r.r for r in ranked), reverse=True)
    assert similar.edges_of(asked.where("mid = 999")).count() == 0


def test_a_users_bits_follow_what_they_rated(spark):
    mids = [i * 30_011 for i in range(40)]
    rows = spark.createDataFrame([(1, m) for m in mids], "uid int, mid int")
    bits = rated_bitmaps(rows)
    assert len(bits.selectExpr("CAST(to_json(seen) AS STRING) AS s").first().s) < 40 * 100     # was 4 KB a bucket
    ask = spark.createDataFrame([(1, m + d) for m in mids for d in (0, 1)], "uid int, rid int")
    got = ask.join(bits, "uid").where(in_bitmaps("seen", "rid")).collect()
    assert sorted(r.rid for r in got) == mids


def test_many_keys_of_a_point_table(spark, tmp_path):
    from ratingflow.sinks.history import EdgeTable
    table = EdgeTable(str(tmp_path / "edges"), buckets=4)
    table.load(spark.range(9000).selectExpr("CAST(id AS INT) AS mid", "CAST(id + 1 AS INT) AS rid", "0.5D AS r"))
    asked = spark.range(0, 9000).where("id % 9 != 0").selectExpr("CAST(id AS INT) AS mid")
    got = table.of_movies(asked).collect()      # one scan of so many keys ran out of stack
    assert sorted(r.mid for r in got) == [m for m in range(9000) if m % 9]


def test_zero_users_go_no_further_than_the_smallest_ids(spark):
    rng = np.random.default_rng(9)
    right = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1000, 4)))], "id_r int, v_r array<double>")
    left = spark.createDataFrame([(u, [0.0] * 4) for u in range(20)], "id int, v array<double>")
    found = pruned.falling_norms(left, right, 5, None, 2, 4, 1 << 16, 1000)
    report = found.report().first()
    assert report.cells == 20_000 and report.cells_multiplied < report.cells / 10
    named = left.toDF("uid", "features"), right.toDF("mid", "features")
    got = blocked.top_k_products(*named, 5, left_id="uid", right_id="mid", prune=True).collect()
    assert sorted((r.uid, r.pos, r.rid) for r in got) == [(u, p + 1, p) for u in range(20) for p in range(5)]


def test_shuffled_factors_go_with_each_iteration(spark):
    from ratingflow.operators.model import als
    assert als().getCheckpointInterval() == 1


def test_plain_products_of_many_rows(spark):
    """More products than are made at a time."""
    from ratingflow.plans.queries import plain_products
    asked = spark.range(3000).selectExpr("CAST(id AS INT) AS a", "array(CAST(id AS DOUBLE)) AS u", "2999.5D AS least")
    rows = spark.range(4000).selectExpr("CAST(id AS INT) AS mid", "array(IF(id = 7, 1.001D, 0.0D)) AS v")
    got = plain_products(asked, rows, blocks=1).collect()
    assert sorted((r.a, r.mid) for r in got) == [(a, 7) for a in range(3000) if a * 1.001 > 2999.5]


def test_products_are_sieved_in_single_precision(monkeypatch):
    """All but the rows that allow no sieve go through it, with the results of doubles."""
    rng = np.random.default_rng(12)
    right = rng.normal(size=(6000, 16)) * rng.choice([1e-3, 1.0, 50.0], (6000, 1))
    right[3000:3400] = right[7]                        # copies: the smallest ids first
    left = np.concatenate([rng.normal(size=(700, 16)), right[7:8] * 2, np.zeros((2, 16)), np.full((1, 16), np.nan)])
    kk = rng.integers(1, 30, len(left))
    plain, seen = blocked._plain_best, []
    monkeypatch.setattr(blocked, "_plain_best", lambda lm, *rest: (seen.append(len(lm)), plain(lm, *rest))[1])
    scores = left @ right.T
    for floor in (np.full(len(left), -np.inf), np.where(np.arange(len(left)) % 2, -np.inf, np.sort(scores, axis=1)[:, -15] - 1e-9)):
        got = {}
        for li, ri, s in blocked._best_products(left, right, kk, floor):
            for a, b, c in zip(li.tolist(), ri.tolist(), s.tolist()):
                got.setdefault(a, []).append((b, c))
        for u in range(len(left) - 1):
            s = np.einsum("ij,ij->i", np.broadcast_to(left[u], right.shape), right)
            want = [i for i in np.lexsort((np.arange(6000), -s))[:kk[u]] if s[i] >= floor[u]]
            assert sorted(b for b, _ in got[u]) == sorted(want) and all(abs(s[b] - c) < 1e-9 for b, c in got[u])
        assert len(left) - 1 not in got
    assert seen == [3, 3]
    monkeypatch.setattr(blocked, "SIEVE_MOST", 0)      # too many equal scores: doubles for that tile
    many = np.ones((5000, 2))
    li, ri, s = next(blocked._best_products(np.ones((1, 2)), many, np.array([3]), np.array([-np.inf])))
    assert ri.tolist() == [0, 1, 2] and seen[-1] == 1


def test_later_blocks_hand_on_only_what_betters_a_list(spark):
    rng = np.random.default_rng(10)
    items = rng.normal(size=(2000, 4))
    items /= np.linalg.norm(items, axis=1, keepdims=True)
    items[:100] *= 1.0001
    left = spark.createDataFrame([(u, v.tolist()) for u, v in enumerate(rng.normal(size=(40, 4)))], "id int, v array<double>")
    right = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "id_r int, v_r array<double>")
    found = pruned.falling_norms(left, right, 20, None, 1, 10, 1 << 16, 2000)
    floors = {r.id: r.reach for r in found.left.collect()}
    more = found.candidates().exceptAll(found.first).collect()
    assert more and all(r.r >= floors[r.uid] for r in more)      # was 20 of each block, 8,000 in all


def test_packed_edges_are_nested_as_rows_are(spark):
    from ratingflow.operators.similarity import nest_edges, packed_item_similarity
    rng = np.random.default_rng(14)
    m = rng.normal(size=(300, 4))
    m[:40] = m[0]                                      # equal scores, by id
    ids = [int(i) for i in np.concatenate([rng.permutation(298), [2_000_000_000, -2_000_000_000]])]
    rows = [(i, v.tolist()) for i, v in zip(ids, m)] + [(5000, [0.0] * 4), (5001, None)]
    v = spark.createDataFrame(rows + rows[:9], "mid int, features array<double>")
    key = lambda r: (r.mid, [(x.rid, round(x.r, 9)) for x in r.recs])
    want = sorted(map(key, nest_edges(item_similarity(v, 0.5)).collect()))
    got = sorted(map(key, nest_edges(packed_item_similarity(v, 0.5)).collect()))
    assert len(want) > 200 and got == want
    pages = sorted(nest_edges(packed_item_similarity(v, 0.5), page_rows=7).collect(), key=lambda p: (p.mid, p.page))
    lists = {}
    for p in pages:
        assert len(lists.setdefault(p.mid, [])) == 7 * p.page and 0 < len(p.recs) <= 7
        lists[p.mid] += [(x.rid, round(x.r, 9)) for x in p.recs]
    assert sorted(lists.items()) == [(a, b) for a, b in want]
    none = packed_item_similarity(v.where("mid > 4999 AND mid < 6000"), 0.5)
    assert nest_edges(none).count() == 0 and nest_edges(none, page_rows=5).count() == 0


def test_runs_take_a_fraction_of_rows_and_merge_in_any_batches():
    import zlib

    import pyarrow as pa

    from ratingflow.operators import runs
    rng = np.random.default_rng(15)
    mid = np.repeat(np.arange(50), 400).astype(np.int32)
    rid = np.concatenate([rng.choice(100_000, 400, replace=False) for _ in range(50)]).astype(np.int32)
    r = rng.uniform(0.3, 0.6, len(mid))
    packed = [runs.pack(mid[part], rid[part], r[part]) for part in np.array_split(rng.permutation(len(mid)), 3)]
    sent = sorted(((int(a), b) for p in packed for a, b in zip(p["mid"], p["run"])), key=lambda x: x[0])
    assert len(zlib.compress(b"".join(b for _, b in sent), 1)) < 10.5 * len(mid)      # a row takes 32 before compression
    want = {(int(a), int(b)): c for a, b, c in zip(mid, rid, r)}
    for size, most in ((1, 1), (7, 900), (1000, 1 << 21)):
        runs.MERGE_EDGES = most
        batches = [pa.RecordBatch.from_pydict({"mid": pa.array([a for a, _ in sent[i:i + size]], pa.int32()),
                                               "run": pa.array([b for _, b in sent[i:i + size]], pa.binary())})
                   for i in range(0, len(sent), size)]
        out = [row for b in runs._merge_fn(None)(iter(batches)) for row in b.to_pylist()]
        assert [row["mid"] for row in out] == list(range(50))
        assert {(row["mid"], x["rid"]): x["r"] for row in out for x in row["recs"]} == want
        assert all(row["recs"] == sorted(row["recs"], key=lambda x: (-x["r"], x["rid"])) for row in out)
    runs.MERGE_EDGES = 1 << 21


def test_vectors_that_cannot_be_pruned_go_to_even_blocks(spark, monkeypatch):
    rng = np.random.default_rng(16)
    monkeypatch.setattr(blocked, "PRUNE_FROM", 100)
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(300, 16)))], "mid int, features array<double>")
    groups, n = blocked._block_pairs(v, 0.3, "mid", "features", 1 << 16, 5, False, None)
    assert n == 300 and groups.count().columns == ["bi", "bj", "count"]
    assert groups.count().agg({"count": "sum"}).first()[0] == 300 * 6       # was more, by the clusters' sizes


def shuffle_files(spark) -> int:
    import os
    import time
    time.sleep(1)       # they are removed beside the run
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return sum(x.startswith("shuffle_") for d in dirs for _, _, names in os.walk(d) for x in names)


def test_shuffle_files_go_as_a_run_ends(spark):
    from ratingflow.session import freed_shuffles
    before, rows = shuffle_files(spark), spark.range(1000)
    with freed_shuffles(spark):
        counts = rows.repartition(3).groupBy("id").count()
        assert len(counts.collect()) == 1000 and shuffle_files(spark) <= before
    assert len(counts.collect()) == 1000        # made again
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")


def test_blocks_of_a_best_k_product_follow_their_bytes(spark):
    """The larger the blocks, the fewer copies of rows are shuffled."""
    wide = lambda d, n: spark.range(n).selectExpr("id", f"array_repeat(1.0D, {d}) AS v")
    n_left, n_right, rows = blocked._block_rows(wide(64, 9), wide(64, 5).toDF("id_r", "v_r"))
    assert (n_left, n_right, rows) == (9, 5, 1 << 18)
    nl, nr = blocked.plan_pair_blocks(5_400_000, 720_000, 12, rows)
    assert 5_400_000 * nr + 720_000 * nl < 32_000_000       # was 119 million
    assert blocked._block_rows(wide(1024, 9), wide(64, 0).toDF("id_r", "v_r"))[2] == 1 << 14


def test_edge_table_of_packed_edges(spark, tmp_path):
    """One shuffle of packed edges, and a row a page; it was a row an edge, shuffled four times."""
    from ratingflow.operators.similarity import packed_item_similarity
    from ratingflow.sinks.history import PAGE_EDGES, EdgeTable
    rng = np.random.default_rng(21)
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(1500, 4)))], "mid int, features array<double>")
    plain, packed = (EdgeTable(str(tmp_path / name), buckets=4) for name in ("plain", "packed"))
    edges = item_similarity(v, 0.1).checkpoint()
    plain.load(edges)
    packed.load(packed_item_similarity(v, 0.1))
    asked = spark.createDataFrame([(m,) for m in (0, 7, 1499, 5000)], "mid int")
    key = lambda r: (r.mid, r.pos, r.rid, round(r.r, 9))
    want = []
    for m in (0, 7, 1499):
        own = sorted(((-e.r, e.rid) for e in edges.where(f"mid = {m}").collect()))
        assert len(own) > PAGE_EDGES
        want += [(m, i, rid, round(-r, 9)) for i, (r, rid) in enumerate(own, 1)]
    for table in (plain, packed):
        assert sorted(map(key, table.of_movies(asked).collect())) == want
    files = spark.read.parquet(packed.path)
    assert files.count() < edges.count() / 300 and files.groupBy("ub").count().count() == 4


def test_edge_facts_tell_of_one_way_edges(spark):
    from ratingflow.plans.queries import edge_facts, one_way_edges
    rng = np.random.default_rng(5)
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(200, 4)))], "mid int, features array<double>")
    e = item_similarity(v, 0.5).checkpoint()
    facts = edge_facts(e, 0.5)
    own = facts.where("rid is not null")
    assert facts.agg({"n": "sum"}).first()[0] == e.count() and own.count() == e.where("mid % 50 = 0").count()
    assert own.join(e, ["mid", "rid", "r"]).count() == own.count() and facts.count() < e.count() / 4
    assert one_way_edges(e, facts).first() == (0,)
    gone = e.where("not (mid = 3 and rid < 50)")
    n = e.where("mid = 3 and rid < 50").count()
    assert n and one_way_edges(gone, edge_facts(gone, 0.5)).first() == (n,)
    near = e.selectExpr("mid", "rid", "IF(mid < rid, r, r + 1e-8) AS r")        # another value, but close enough
    assert one_way_edges(near, edge_facts(near, 0.5)).first() == (0,)


def test_pairs_above_are_sieved_in_single_precision(monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 16))
    x[50:60] = x[40:50]
    x /= np.linalg.norm(x, axis=1)[:, None]
    for share in (1 / 32, 0, 1):            # few above a tile, too many, any number
        monkeypatch.setattr(blocked, "SIEVE_SHARE", share)
        got = {(i, j): s for a, b, z in blocked._above(x[:700], x, 0.6) for i, j, s in zip(a.tolist(), b.tolist(), z)}
        want = x[:700] @ x.T
        assert set(got) == set(zip(*(z.tolist() for z in np.nonzero(want > 0.6))))
        assert max(abs(want[k] - s) for k, s in got.items()) < 1e-12


def test_predictions_by_block(spark):
    """The rows and values of Spark ML's; pairs were shuffled with their users' factors."""
    from ratingflow.operators import model
    rng = np.random.default_rng(3)
    rows = [(int(u), int(m), float(rng.integers(1, 11)) / 2, f"t{u}") for u, m in rng.integers(0, 60, (900, 2))]
    r = spark.createDataFrame(rows + rows[:30], "uid int, mid int, score double, tag string")
    m = model.fit(r, rank=5, max_iter=2, reg=0.1)
    asked = r.union(spark.createDataFrame([(999, 1, 1.0, None), (1, 999, 1.0, "x")], r.schema))
    got = model.predict(m, asked)
    assert got.columns == [*r.columns, "prediction"]
    key = lambda x: (x.uid, x.mid, x.score, str(x.tag), x.prediction)
    got, want = (sorted(map(key, x.collect())) for x in (got, m.transform(asked)))
    assert [x[:4] for x in got] == [x[:4] for x in want] and len(got) == 930
    assert max(abs(a[4] - b[4]) for a, b in zip(got, want)) < 1e-4
    assert model.predict(m, asked.where("uid = 999")).count() == 0


def test_training_leaves_no_shuffle_files(spark):
    from ratingflow.operators import model
    before = shuffle_files(spark)
    r = spark.range(3000).selectExpr("CAST(id % 70 AS INT) AS uid", "CAST(id % 41 AS INT) AS mid", "CAST(id % 5 AS DOUBLE) AS score")
    m = model.fit(r, rank=4, max_iter=3, reg=0.1)
    assert shuffle_files(spark) <= before
    n = m.userFactors.count()
    model.release(m)
    assert m.userFactors.count() == n == 70      # worked out again


def test_lists_of_hot_movies_come_in_parts(spark, monkeypatch):
    """No task holds a hot movie's list, and its pages are those of one list; equal values too."""
    from ratingflow.operators import runs
    monkeypatch.setattr(runs, "HOT_EDGES", 500)
    monkeypatch.setattr(runs, "HOT_SAMPLE", 50)
    monkeypatch.setattr(runs, "PACK_ROWS", 700)
    rng = np.random.default_rng(31)
    rows = [(-1, int(i) * 10 ** 9 - 5, round(float(x), 3)) for i, x in enumerate(rng.random(4321))]
    rows += [(7, i, 0.5) for i in range(1800)] + [(int(m), int(i), float(x)) for m, i, x in zip(rng.integers(8, 40, 900), rng.permutation(900), rng.random(900))]
    rows += rows[:40]
    edges = spark.createDataFrame(rows, "mid int, rid long, r double").repartition(5)
    parts, seen = runs._pages, []
    pages = runs.nest_rows(edges, 30).collect()
    want = {}
    for m, i, x in sorted(rows, key=lambda e: (e[0], -e[2], e[1])):
        want.setdefault(m, []).append((i, x))
    got = {(p.mid, p.page): [tuple(x) for x in p.recs] for p in pages}
    assert len(got) == len(pages)
    assert got == {(m, n): own[n * 30:n * 30 + 30] for m, own in want.items() for n in range(-(-len(own) // 30))}
    # int ids without hot movies, and rows that go the old way
    monkeypatch.setattr(runs, "HOT_EDGES", 1 << 21)
    few = runs.nest_rows(edges.selectExpr("mid", "CAST(rid % 1000 AS INT) AS rid", "r"), 10_000).collect()
    assert {p.mid: len(p.recs) for p in few} == {m: len(own) for m, own in want.items()}
    assert runs.nest_rows(edges.selectExpr("mid", "IF(rid = 3, NULL, rid) AS rid", "r").where("mid = 7"), 30) is None


def test_parts_of_an_edge():
    from ratingflow.operators.runs import _parts
    borders = {5: (np.array([-0.9, -0.5, -0.5, -0.1]), np.array([3, 2, 8, 0]))}
    mid, rid = np.full(9, 5), np.array([9, 2, 3, 1, 2, 7, 8, 99, 0])
    r = np.array([0.95, 0.9, 0.9, 0.5, 0.5, 0.5, 0.5, 0.3, 0.1])
    assert _parts(mid, rid, r, borders).tolist() == [0, 0, 1, 1, 2, 2, 3, 3, 4]
    assert _parts(mid + 1, rid, r, borders).tolist() == [0] * 9


def test_blocks_of_a_fit_hold_a_bounded_number_of_ratings(spark, monkeypatch):
    from ratingflow.operators import model
    assert [model.blocks_for(n) for n in (0, 36_000_000, 216_000_000)] == [10, 10, 26]     # was 10 at any size
    made, als = [], model.als
    monkeypatch.setattr(model, "als", lambda *a: (made.append(a[-1]), als(*a))[1])
    monkeypatch.setattr(model, "RATINGS_A_BLOCK", 100)
    r = spark.range(1300).selectExpr("CAST(id % 70 AS INT) AS uid", "CAST(id % 41 AS INT) AS mid", "CAST(id % 5 AS DOUBLE) AS score")
    assert model.fit(r, rank=3, max_iter=2, reg=0.1).itemFactors.count() == 41
    model.fit(r, rank=3, max_iter=1, blocks=4)
    assert made == [13, 4]
