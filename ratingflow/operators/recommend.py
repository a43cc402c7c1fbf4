"""Real-time re-scoring as pure DataFrame functions.

For each incoming rating message (uid, mid):
  1. recent   : the user's newest ``recent_k`` ratings from history
  2. candidates: movies similar to ``mid`` that the user has not rated,
                 best ``cand_k`` by similarity
  3. score    : for each candidate c, over the recent ratings (m, s) whose
                similarity sim(c, m) > t:
                  avg(sim * s) + log2(max(#likes,1)) - log2(max(#dislikes,1))
                with like = s > like_above
  4. recs     : candidates by score, one row per user of the batch
  5. replace  : the user's old rec row is replaced by the new one

The same functions serve the batch queries and every micro-batch of the
stream (``streaming.recommender``).  Inputs:
  batch(uid, mid, ...), history(uid, mid, score, timestamp),
  edges(mid, rid, r) = directed similarity mid -> rid.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingflow import schemas
from ratingflow.functions.scalar import bounded_log2
from ratingflow.operators.hubs import hub_join
from ratingflow.operators.places import placed
from ratingflow.operators.topk import collect_sorted, nest, top_k


def like_dislike(df: DataFrame, by: Sequence[str], like_above: float = 3.0,
                 score: str = "score") -> DataFrame:
    """(by..., n_like, n_dislike): a score above ``like_above`` is a like,
    anything else (including exactly ``like_above``) a dislike."""
    s = F.col(score)
    return df.groupBy(*by).agg(F.count_if(s > like_above).alias("n_like"),
                               F.count_if(s <= like_above).alias("n_dislike"))


def recent_ratings(history: DataFrame, k: int = 20) -> DataFrame:
    """(uid, pos, mid, score): newest ``k`` ratings per user, order
    timestamp desc, mid asc, score asc."""
    ranked = top_k(history, ["uid"],
                   [F.col("timestamp").desc(), F.col("mid").asc(), F.col("score").asc()], k)
    return ranked.select("uid", "pos", "mid", "score")


def latest_per_user(batch: DataFrame) -> DataFrame:
    """(uid, mid, score, timestamp): the newest message of each user in a
    batch (timestamp desc, then mid asc).  A max-of-struct aggregate, so a
    user with a flood of messages is reduced map-side before the shuffle."""
    best = F.max(F.struct(F.col("timestamp"), (-F.col("mid")).alias("neg_mid"),
                          F.col("mid"), F.col("score"))).alias("m")
    return batch.groupBy("uid").agg(best).select("uid", "m.mid", "m.score", "m.timestamp")


SLICE = 32      # bytes of a bitmap's slice: 256 movies


def rated_bitmaps(history: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """(uid, n, seen): how many movies a user has rated, and which, as a map
    from the movie's bucket of 32,768 ids to the slices of its bitmap.

    Of a bitmap only the slices that hold a bit are kept, by number, so that a
    user's row follows what they have rated, not the catalogue; a bit a movie
    and some is its bound.  The semi join first cuts the history to ``users``,
    if given.  Repeats go first, then a user's movies come to one task, where
    the bitmaps are made and cut: none is shipped whole."""
    if users is not None:
        history = history.join(users.select("uid").distinct(), "uid", "left_semi")
    pairs = history.where("mid is not null").select("uid", "mid").distinct().repartition("uid")
    bits = (pairs.groupBy("uid", F.bitmap_bucket_number("mid").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("mid")).alias("bits")))
    cut = F.transform(F.sequence(F.lit(0), F.lit(4096 // SLICE - 1)), lambda i: F.struct(
        i.alias("slice"), F.substring("bits", i * SLICE + 1, F.lit(SLICE)).alias("bits")))
    some = F.map_from_entries(F.filter(cut, lambda x: x["bits"] != F.lit(bytes(SLICE))))
    kept = bits.select("uid", "bucket", F.bitmap_count("bits").alias("n"), some.alias("slices"))
    return kept.groupBy("uid").agg(F.sum("n").alias("n"),
                                   F.map_from_entries(F.collect_list(F.struct("bucket", "slices"))).alias("seen"))


def in_bitmaps(seen: Column | str, mid: Column | str) -> Column:
    """Whether the movie's bit is set; false for users without bitmaps."""
    place = F.bitmap_bit_position(mid)
    slices = F.try_element_at(F.col(seen) if isinstance(seen, str) else seen, F.bitmap_bucket_number(mid))
    bits = F.try_element_at(slices, F.floor(place / (8 * SLICE)).cast("int"))
    at = F.floor(place % (8 * SLICE) / 8).cast("int")
    byte = F.conv(F.hex(F.substring(bits, at + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (place % 8).cast("int"))
    return F.coalesce(bit.bitwiseAND(F.lit(1)) != 0, F.lit(False))


def ranked_edges(edges: DataFrame, spread: bool = False) -> DataFrame:
    """(mid, rid, r, pos): one edge a pair (the largest ``r`` of copies), with
    its place among the movie's edges (r desc, rid asc).  ``spread``: a movie's
    edges may be too many for one task (see ``places.placed``)."""
    one = edges.groupBy("mid", "rid").agg(F.max("r").alias("r"))
    if spread:
        return placed(one, ["mid"], [F.col("r").desc(), F.col("rid").asc()])
    w = Window.partitionBy("mid").orderBy(F.col("r").desc(), F.col("rid").asc())
    return one.withColumn("pos", F.row_number().over(w))


def candidates(batch: DataFrame, history: DataFrame | None, edges: DataFrame, k: int = 20,
               rated: DataFrame | None = None, spread: bool = False) -> DataFrame:
    """(uid, mid, pos, rid, r): for each (uid, mid) of ``batch``, the ``k``
    most similar movies to ``mid`` not rated by ``uid`` (r desc, rid asc).
    A movie without edges yields no candidates.

    ``rated`` is ``rated_bitmaps`` if the caller has it; ``edges`` may come
    ranked (``ranked_edges``), else the batch's movies' edges are ranked here.
    A user with n rated movies needs a movie's best k + n edges at most; of
    these the join itself drops the rated ones, by their bits, so that pairs
    are not shuffled before the ranking.  ``spread``: a few movies may be named
    by very many messages, or have very many edges."""
    src = batch.select("uid", "mid").distinct()
    if rated is None:
        rated = rated_bitmaps(history, src)
    if "pos" not in edges.columns:
        edges = ranked_edges(edges.join(src.select("mid").distinct(), "mid", "left_semi"), spread)
    # sorted, not broadcast: shuffled bitmaps tell a fraction of their size, and
    # the driver would hold them whole
    need = src.join(rated.hint("merge"), "uid", "left")
    places = edges.select("mid", "rid", "r", F.col("pos").alias("_place"))
    joined = hub_join(need, places, "mid", "uid", counted=src) if spread else need.hint("merge").join(places, "mid")
    unseen = (joined.where(F.col("_place") <= F.lit(k) + F.coalesce("n", F.lit(0)))
              .where(~in_bitmaps("seen", "rid")).select("uid", "mid", "rid", "r"))
    ranked = top_k(unseen, ["uid", "mid"], [F.col("r").desc(), F.col("rid").asc()], k)
    return ranked.select("uid", "mid", "pos", "rid", "r")


def score_pairs(cands: DataFrame, recent: DataFrame) -> DataFrame:
    """(uid, mid, rid, rmid, score): every candidate of a message with every
    recent rating of its user (<= cand_k * recent_k rows per message)."""
    c = cands.select("uid", "mid", "rid")
    rc = recent.select("uid", F.col("mid").alias("rmid"), "score")
    return c.join(rc, "uid")


def scores(cands: DataFrame, recent: DataFrame, edges: DataFrame, threshold: float = 0.6,
           like_above: float = 3.0) -> DataFrame:
    """(uid, mid, rid, score) for candidates with at least one recent rating
    whose similarity to the candidate is above ``threshold``.

    Joins: candidates x recent on uid, then the edge candidate -> recent
    movie on the pair key (``edges`` has one row a pair).  A missing pair
    counts as similarity 0, which no threshold of 0 or more lets pass.
    """
    if threshold < 0:
        raise ValueError("threshold must be >= 0")
    e = edges.select(F.col("mid").alias("rid"), F.col("rid").alias("rmid"),
                     F.col("r").alias("sim")).where(F.col("sim") > threshold)
    # a rated movie that no edge leads to would only be paired and dropped
    known = recent.join(e.select(F.col("rmid").alias("mid")).distinct(), "mid", "left_semi")
    j = score_pairs(cands, known).join(e, ["rid", "rmid"])
    s = F.col("score")
    agg = j.groupBy("uid", "mid", "rid").agg(
        F.avg(F.col("sim") * s).alias("base"),
        F.count_if(s > like_above).alias("n_like"),
        F.count_if(s <= like_above).alias("n_dislike"))
    return agg.select("uid", "mid", "rid",
                      (F.col("base") + bounded_log2("n_like") - bounded_log2("n_dislike")).alias("score"))


def to_recs(latest: DataFrame, scored: DataFrame, k: int | None = None) -> DataFrame:
    """(uid, recs array<struct<rid,r>>): one row per user of ``latest``,
    items by score desc, rid asc; an empty list when nothing scored."""
    s = scored.select("uid", "rid", F.col("score").alias("r"))
    if k is None:
        nested = collect_sorted(s, ["uid"], [("r", True), ("rid", False)], ["rid", "r"])
    else:
        ranked = top_k(s, ["uid"], [F.col("r").desc(), F.col("rid").asc()], k)
        nested = nest(ranked, ["uid"], "pos", ["rid", "r"])
    empty = F.array().cast(schemas.RECS)
    return latest.select("uid").distinct().join(nested, "uid", "left") \
        .select("uid", F.coalesce(F.col("recs"), empty).alias("recs"))


def replace_by_key(old: DataFrame, new: DataFrame, key: str | Sequence[str] = "uid") -> DataFrame:
    """Rows of ``old`` whose key is not in ``new``, plus all of ``new``."""
    keys = [key] if isinstance(key, str) else list(key)
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def rescore(batch: DataFrame, history: DataFrame, edges: DataFrame | None, *, recent_k: int = 20,
            cand_k: int = 20, threshold: float = 0.6, like_above: float = 3.0,
            own_history: bool = False, spread: bool = False,
            edges_of: Callable[[DataFrame], DataFrame] | None = None,
            pairs_of: Callable[[DataFrame], DataFrame] | None = None,
            hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Steps 1-4 for one batch of messages: (uid, recs).

    ``own_history``: the caller has cut ``history`` to the batch's users
    already; otherwise one semi join does.  ``edges`` may come ranked.
    ``spread``: see ``candidates``.  ``edges_of`` gives the ranked edges of a
    table of movies (mid), in place of ``edges``: those of the messages' movies,
    then those of the candidates, which are read twice and go through ``hold``;
    ``pairs_of`` may give the latter without their ranks.
    """
    latest = latest_per_user(batch)
    if not own_history:
        history = history.join(latest.select("uid"), "uid", "left_semi")
    if edges_of is None and "pos" not in edges.columns:
        edges = ranked_edges(edges)
    recent = recent_ratings(history, recent_k)
    near = edges_of(latest) if edges_of else edges
    cands = candidates(latest, None, near, cand_k, rated=rated_bitmaps(history), spread=spread)
    if edges_of:
        cands = hold(cands)
        edges = (pairs_of or edges_of)(cands.select(F.col("rid").alias("mid")))
    scored = scores(cands, recent, edges, threshold, like_above).select("uid", "rid", "score")
    return to_recs(latest, scored)
