"""Property tests: operators against brute force on random small tables."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ratingflow.operators import recommend as R
from ratingflow.operators import stats

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

ratings_st = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 12), st.sampled_from([0.5, 1.0, 2.5, 3.0, 3.5, 5.0]),
              st.integers(0, 6)),
    min_size=1, max_size=60)
HIST = "uid int, mid int, score double, timestamp int"


@SETTINGS
@given(rows=ratings_st, k=st.integers(1, 5))
def test_recent_ratings_brute_force(spark, rows, k):
    got = {}
    for r in R.recent_ratings(spark.createDataFrame(rows, HIST), k).collect():
        got.setdefault(r.uid, []).append((r.pos, r.mid, r.score))
    want = {}
    for u in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == u), key=lambda t: (-t[3], t[1], t[2]))[:k]
        want[u] = [(i + 1, t[1], t[2]) for i, t in enumerate(mine)]
    assert {u: sorted(v) for u, v in got.items()} == want


@SETTINGS
@given(rows=ratings_st)
def test_latest_per_user_brute_force(spark, rows):
    got = {r.uid: (r.mid, r.timestamp) for r in R.latest_per_user(spark.createDataFrame(rows, HIST)).collect()}
    want = {}
    for u in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == u), key=lambda t: (-t[3], t[1], -t[2]))[0]
        want[u] = (best[1], best[3])
    assert got == want


@SETTINGS
@given(rows=ratings_st)
def test_counts_and_averages_brute_force(spark, rows):
    df = spark.createDataFrame(rows, HIST)
    counts = {r.mid: r["count"] for r in stats.rating_count_by_movie(df).collect()}
    avgs = {r.mid: r.avg for r in stats.average_score_by_movie(df).collect()}
    likes = {r.mid: (r.n_like, r.n_dislike) for r in R.like_dislike(df, ["mid"]).collect()}
    for m in {r[1] for r in rows}:
        mine = [r[2] for r in rows if r[1] == m]
        assert counts[m] == len(mine)
        assert math.isclose(avgs[m], sum(mine) / len(mine))
        assert likes[m] == (sum(s > 3 for s in mine), sum(s <= 3 for s in mine))
    monthly = stats.rating_count_by_month(df).groupBy().sum("count").first()[0]
    assert monthly == len(rows)


@SETTINGS
@given(old=st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=8),
       new=st.dictionaries(st.integers(0, 9), st.integers(100, 199), max_size=8))
def test_replace_by_key_brute_force(spark, old, new):
    schema = "uid int, v int"
    o = spark.createDataFrame(list(old.items()), schema)
    n = spark.createDataFrame(list(new.items()), schema)
    got = dict(tuple(r) for r in R.replace_by_key(o, n).collect())
    assert got == {**old, **new}


@SETTINGS
@given(movies=st.lists(st.tuples(st.sampled_from(["Red|ring", "small|RED", "bolt", "Small|gear"]),
                                 st.sampled_from([1.0, 2.5, 4.0, 4.5])), min_size=1, max_size=25),
       k=st.integers(1, 4))
def test_genre_top_brute_force(spark, movies, k):
    rows = [(i, "n", g, a) for i, (g, a) in enumerate(movies)]
    mwa = spark.createDataFrame(rows, "mid int, name string, genres string, avg double")
    genres = ["red", "Small", "gear", "none"]
    got = {}
    for r in stats.genre_top_exploded(mwa, genres, k).collect():
        got.setdefault(r.genres, []).append((r.pos, r.rid))
    want = {}
    for g in genres:
        hits = sorted((r for r in rows if g.lower() in r[2].lower()), key=lambda t: (-t[3], t[0]))[:k]
        if hits:
            want[g] = [(i + 1, t[0]) for i, t in enumerate(hits)]
    assert {g: sorted(v) for g, v in got.items()} == want


@SETTINGS
@given(rows=ratings_st)
def test_rollup_equals_direct_statistics(spark, rows):
    rows = [(u, m, s, 1260759179 + t * 86400 * 40) for u, m, s, t in rows]  # several months
    df = spark.createDataFrame(rows, HIST)
    rollup = stats.movie_month_rollup(df)
    monthly = sorted(map(tuple, rollup.select("mid", "count", "yearmonth").collect()))
    assert monthly == sorted(map(tuple, stats.rating_count_by_month(df).collect()))
    per_movie = {r.mid: (r["count"], r.avg) for r in stats.per_movie_from_rollup(rollup).collect()}
    direct_n = {r.mid: r["count"] for r in stats.rating_count_by_movie(df).collect()}
    direct_avg = {r.mid: r.avg for r in stats.average_score_by_movie(df).collect()}
    assert {m: v[0] for m, v in per_movie.items()} == direct_n
    assert {m: v[1] for m, v in per_movie.items()} == direct_avg   # half-star sums are exact


def _brute_rescore(history, edges, batch, k_recent, k_cand, t, like_above=3.0):
    """The re-scoring rules of SURVEY §7 in plain Python."""
    out = {}
    for uid in {b[0] for b in batch}:
        latest = max((b for b in batch if b[0] == uid), key=lambda b: (b[3], -b[1]))
        mine = [h for h in history if h[0] == uid]
        recent = sorted(mine, key=lambda h: (-h[3], h[1], h[2]))[:k_recent]
        rated = {h[1] for h in mine}
        sims = edges.get(latest[1], {})
        cands = sorted(((r, c) for c, r in sims.items() if c not in rated), key=lambda x: (-x[0], x[1]))
        scored = []
        for _, c in cands[:k_cand]:
            terms = [(edges.get(c, {}).get(m, 0.0), s) for _, m, s, _ in recent]
            terms = [(sim, s) for sim, s in terms if sim > t]
            if terms:
                likes = sum(s > like_above for _, s in terms)
                score = (sum(sim * s for sim, s in terms) / len(terms)
                         + math.log2(max(likes, 1)) - math.log2(max(len(terms) - likes, 1)))
                scored.append((c, score))
        out[uid] = sorted(scored, key=lambda x: (-x[1], x[0]))
    return out


edge_st = st.dictionaries(st.tuples(st.integers(0, 9), st.integers(0, 9)),
                          st.sampled_from([0.1, 0.35, 0.5, 0.61, 0.7, 0.85, 0.99]), max_size=50)


@SETTINGS
@given(history=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9),
                                  st.sampled_from([1.0, 2.0, 3.0, 3.5, 4.5, 5.0]), st.integers(0, 9)),
                        max_size=40),
       edge_map=edge_st,
       batch=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9), st.just(4.0), st.integers(0, 5)),
                      min_size=1, max_size=6),
       k_recent=st.integers(1, 6), k_cand=st.integers(1, 5))
def test_rescore_brute_force(spark, history, edge_map, batch, k_recent, k_cand):
    edges = {}
    for (a, b), r in edge_map.items():
        if a != b:
            edges.setdefault(a, {})[b] = r
    erows = [(a, b, r) for a, d in edges.items() for b, r in d.items()]
    h = spark.createDataFrame(history, HIST)
    e = spark.createDataFrame(erows, "mid int, rid int, r double")
    b = spark.createDataFrame(batch, HIST)
    got = {row.uid: [(x.rid, x.r) for x in row.recs]
           for row in R.rescore(b, h, e, recent_k=k_recent, cand_k=k_cand, threshold=0.6).collect()}
    want = _brute_rescore(history, edges, batch, k_recent, k_cand, 0.6)
    assert set(got) == set(want)
    for uid in want:
        assert [c for c, _ in got[uid]] == [c for c, _ in want[uid]]
        assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
                   for (_, a), (_, b) in zip(got[uid], want[uid]))


def test_rollup_all_null_scores(spark):
    df = spark.createDataFrame([(1, 5, None, 1260759179), (1, 6, 4.0, 1260759179)], HIST)
    got = {r.mid: (r["count"], r.avg) for r in stats.per_movie_from_rollup(stats.movie_month_rollup(df)).collect()}
    want = {r.mid: r.avg for r in stats.average_score_by_movie(df).collect()}
    assert got == {5: (1, None), 6: (1, 4.0)} and want == {5: None, 6: 4.0}
