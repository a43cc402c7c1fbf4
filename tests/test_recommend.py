"""Stream scoring semantics (FIXTURES §4) and keyed replace."""

import math

from ratingflow.operators import recommend as R

HIST = "uid int, mid int, score double, timestamp int"
EDGE = "mid int, rid int, r double"
MSG = "uid int, mid int, score double, timestamp int"


def test_only_likes_score(spark):
    # candidate 100, two liked recent movies with sims 0.7 and 0.9
    cands = spark.createDataFrame([(1, 9, 100)], "uid int, mid int, rid int")
    recent = spark.createDataFrame([(1, 11, 4.0), (1, 12, 5.0)], "uid int, mid int, score double")
    edges = spark.createDataFrame([(100, 11, 0.7), (100, 12, 0.9)], EDGE)
    row = R.scores(cands, recent, edges, threshold=0.6).first()
    assert math.isclose(row.score, (0.7 * 4 + 0.9 * 5) / 2 + 1.0, rel_tol=1e-12)
    assert math.isclose(row.score, 4.65, rel_tol=1e-12)


def test_score_exactly_three_is_dislike(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 3.5)], "mid int, score double")
    row = R.like_dislike(df, ["mid"]).first()
    assert (row.n_like, row.n_dislike) == (1, 1)


def test_similarity_threshold_strict(spark):
    cands = spark.createDataFrame([(1, 9, 100)], "uid int, mid int, rid int")
    recent = spark.createDataFrame([(1, 11, 4.0)], "uid int, mid int, score double")
    edges = spark.createDataFrame([(100, 11, 0.6)], EDGE)
    assert R.scores(cands, recent, edges, threshold=0.6).count() == 0


def test_mixed_likes_and_dislikes(spark):
    cands = spark.createDataFrame([(1, 9, 100)], "uid int, mid int, rid int")
    recent = spark.createDataFrame([(1, 11, 4.0), (1, 12, 2.0), (1, 13, 1.0), (1, 14, 5.0)],
                                   "uid int, mid int, score double")
    edges = spark.createDataFrame([(100, 11, 0.8), (100, 12, 0.7), (100, 13, 0.9), (100, 14, 0.1)], EDGE)
    row = R.scores(cands, recent, edges, threshold=0.6).first()
    base = (0.8 * 4 + 0.7 * 2 + 0.9 * 1) / 3
    assert math.isclose(row.score, base + math.log2(1) - math.log2(2), rel_tol=1e-12)


def _setup(spark):
    hist = spark.createDataFrame([
        (1, 50, 4.0, 5), (1, 51, 2.0, 6), (1, 60, 5.0, 7),  # user 1 rated 60 (a candidate)
        (2, 50, 4.5, 1)], HIST)
    edges = spark.createDataFrame([
        (10, 60, 0.9), (10, 61, 0.8), (10, 62, 0.7),
        (60, 50, 0.9), (61, 50, 0.95), (61, 51, 0.7), (62, 51, 0.99),
        (20, 60, 0.9)], EDGE)
    return hist, edges


def test_candidates_exclude_rated_and_rank(spark):
    hist, edges = _setup(spark)
    batch = spark.createDataFrame([(1, 10, 4.0, 100)], MSG)
    out = R.candidates(batch, hist, edges, k=20).orderBy("pos").collect()
    assert [(r.rid, r.pos) for r in out] == [(61, 1), (62, 2)]


def test_rescore_end_to_end(spark):
    hist, edges = _setup(spark)
    batch = spark.createDataFrame([(1, 10, 4.0, 100)], MSG)
    recs = R.rescore(batch, hist, edges, threshold=0.6).first()
    # 61: recent (50,4.0) sim .95 like, (51,2.0) sim .7 dislike -> avg + 0 - 0
    s61 = (0.95 * 4 + 0.7 * 2) / 2
    # 62: (51,2.0) sim .99 dislike -> .99*2 + 0 - log2(1)
    s62 = 0.99 * 2
    assert [x.rid for x in recs.recs] == [61, 62]
    assert math.isclose(recs.recs[0].r, s61) and math.isclose(recs.recs[1].r, s62)


def test_unknown_movie_gives_empty_recs(spark):
    hist, edges = _setup(spark)
    batch = spark.createDataFrame([(1, 999, 4.0, 100)], MSG)
    row = R.rescore(batch, hist, edges).first()
    assert row.uid == 1 and row.recs == []


def test_all_candidates_rated_gives_empty_recs(spark):
    hist, edges = _setup(spark)
    batch = spark.createDataFrame([(1, 20, 4.0, 100)], MSG)  # only edge 20->60, rated
    row = R.rescore(batch, hist, edges).first()
    assert row.recs == []


def test_latest_message_per_user_wins(spark):
    batch = spark.createDataFrame([(1, 10, 4.0, 10), (1, 20, 3.0, 20), (2, 7, 1.0, 5),
                                   (2, 5, 1.0, 5)], MSG)
    out = {r.uid: r.mid for r in R.latest_per_user(batch).collect()}
    assert out == {1: 20, 2: 5}


def test_recent_ratings_order_and_k(spark):
    rows = [(1, m, float(m % 5), 100 - (m // 2)) for m in range(30)]
    hist = spark.createDataFrame(rows, HIST)
    out = R.recent_ratings(hist, k=20).orderBy("pos").collect()
    assert len(out) == 20
    expected = sorted(rows, key=lambda t: (-t[3], t[1], t[2]))[:20]
    assert [r.mid for r in out] == [t[1] for t in expected]


def test_replace_by_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "uid int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "uid int, v string")
    out = sorted(tuple(r) for r in R.replace_by_key(old, new).collect())
    assert out == [(1, "a"), (2, "c"), (3, "d")]


def test_keyed_log_replay_is_idempotent(spark, tmp_path):
    from ratingflow.sinks.tables import KeyedLog
    log = KeyedLog(str(tmp_path / "recs"), "uid")
    b0 = spark.createDataFrame([(1, "a"), (2, "b")], "uid int, v string")
    b1 = spark.createDataFrame([(2, "c")], "uid int, v string")
    log.write_batch(b0, 0)
    log.write_batch(b1, 1)
    log.write_batch(b1, 1)  # replayed batch
    out = sorted((r.uid, r.v, r.batch_id) for r in log.current(spark).collect())
    assert out == [(1, "a", 0), (2, "c", 1)]
    assert log.read_log(spark).count() == 3


def test_recs_to_string(spark):
    from ratingflow.functions.scalar import recs_to_string
    df = spark.createDataFrame([([(22, 4.5), (45, 3.8)],)], "recs array<struct<rid:int,r:double>>")
    assert df.select(recs_to_string("recs")).first()[0] == "22:4.5|45:3.8"


def test_empty_batch_has_no_rows(spark):
    hist, edges = _setup(spark)
    batch = spark.createDataFrame([], MSG)
    assert R.rescore(batch, hist, edges).count() == 0


def test_keyed_log_compaction(spark, tmp_path):
    from ratingflow.sinks.tables import KeyedLog
    log = KeyedLog(str(tmp_path / "recs"), "uid")
    schema = "uid int, v string"
    log.write_batch(spark.createDataFrame([(1, "a"), (2, "b")], schema), 0)
    log.write_batch(spark.createDataFrame([(2, "c")], schema), 1)
    assert log.compact(spark) == 1
    assert log.compact(spark) == 1          # idempotent
    log.write_batch(spark.createDataFrame([(1, "d"), (3, "e")], schema), 2)
    out = sorted((r.uid, r.v, r.batch_id) for r in log.current(spark).collect())
    assert out == [(1, "d", 2), (2, "c", 1), (3, "e", 2)]
    # a replayed old batch after compaction does not resurrect old values
    log.write_batch(spark.createDataFrame([(2, "c")], schema), 1)
    assert sorted((r.uid, r.v) for r in log.current(spark).collect()) == [(1, "d"), (2, "c"), (3, "e")]


def test_tag_documents_semantics(spark):
    from ratingflow.operators.documents import search_documents
    movies = spark.createDataFrame([(260, "Star Wars", "Sci-Fi"), (64957, "Button", "Drama"),
                                    (1, "Toy Story", "Animation")], "mid int, name string, genres string")
    tags = spark.createDataFrame([
        (15, 260, "Science Fiction", 1), (20, 260, "Science Fiction", 2),
        (21, 260, "science fiction", 3), (15, 64957, "original plot", 4),
        (16, 64957, "original plot", 5), (16, 64957, "Brad Pitt", 6)],
        "uid int, mid int, tag string, timestamp int")
    docs = {r.mid: r.tags for r in search_documents(movies, tags).collect()}
    assert docs == {260: "Science Fiction|science fiction", 64957: "Brad Pitt|original plot", 1: None}
