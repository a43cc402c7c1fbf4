"""Rating statistics: counts, monthly counts, averages, top movies per genre.

Every aggregate is a hash aggregate with a partial (map-side) step, so a
movie holding a third of all ratings is combined inside each map task and
shuffles one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingflow.functions.scalar import year_month
from ratingflow.operators.topk import nest, top_k


def rating_count_by_movie(ratings: DataFrame) -> DataFrame:
    """(mid, count): ratings per movie."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def rating_count_by_month(ratings: DataFrame) -> DataFrame:
    """(mid, count, yearmonth): ratings per movie and calendar month
    (session time zone)."""
    return (ratings.select("mid", year_month("timestamp").alias("yearmonth"))
            .groupBy("yearmonth", "mid").agg(F.count("mid").alias("count"))
            .select("mid", "count", "yearmonth"))


def average_score_by_movie(ratings: DataFrame) -> DataFrame:
    """(mid, avg): mean score per movie."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def movie_month_rollup(ratings: DataFrame) -> DataFrame:
    """(yearmonth, mid, count, score_sum, score_n): one partial-aggregating
    pass over the raw ratings from which every per-movie statistic rolls
    up exactly (``per_movie_from_rollup``)."""
    return (ratings.select("mid", "score", year_month("timestamp").alias("yearmonth"))
            .groupBy("yearmonth", "mid")
            .agg(F.count("mid").alias("count"), F.sum("score").alias("score_sum"),
                 F.count("score").alias("score_n")))


def per_movie_from_rollup(rollup: DataFrame) -> DataFrame:
    """(mid, count, avg) from ``movie_month_rollup`` - the small table, not
    the raw ratings, is aggregated again.  A movie whose scores are all
    null gets a null average (as ``avg`` does), not a division error."""
    return rollup.groupBy("mid").agg(
        F.sum("count").alias("count"),
        (F.sum("score_sum") / F.nullif(F.sum("score_n"), F.lit(0))).alias("avg"))


def movies_with_average(movies: DataFrame, averages: DataFrame) -> DataFrame:
    """(mid, name, genres, avg): movies that have at least one rating."""
    return movies.join(averages, "mid", "inner")


def genre_candidates(movies_avg: DataFrame, genres: Iterable[str]) -> DataFrame:
    """(genre, mid, avg) for every genre whose name is a case-insensitive
    substring of the movie's genre string.

    The genre list is a literal of the plan: each movie keeps the genres it
    contains and is exploded by them, so there is no join."""
    names = F.array(*[F.struct(F.lit(g).alias("genre"), F.lit(g.lower()).alias("low")) for g in genres])
    own = F.filter(names, lambda g: F.contains(F.col("_lm"), g["low"]))
    m = movies_avg.select("mid", "avg", F.lower("genres").alias("_lm"))
    return m.select(F.explode(own).alias("g"), "mid", "avg").select("g.genre", "mid", "avg")


def genre_top_exploded(movies_avg: DataFrame, genres: Iterable[str], k: int = 10) -> DataFrame:
    """(genres, pos, rid, r): top ``k`` movies per genre by average score,
    ties broken by mid ascending."""
    cand = genre_candidates(movies_avg, genres)
    ranked = top_k(cand, ["genre"], [F.col("avg").desc(), F.col("mid").asc()], k)
    return ranked.select(F.col("genre").alias("genres"), "pos",
                         F.col("mid").alias("rid"), F.col("avg").alias("r"))


def genre_top_movies(movies_avg: DataFrame, genres: Iterable[str], k: int = 10) -> DataFrame:
    """(genres, recs array<struct<rid,r>>): the keyed genre table."""
    return nest(genre_top_exploded(movies_avg, genres, k), ["genres"], "pos", ["rid", "r"])


def register_views(spark: SparkSession, ratings: DataFrame) -> None:
    """The SQL surface of the statistics job: view ``ratings`` and
    ``ratingCountByMonth`` plus the ``changeDate`` SQL function."""
    from ratingflow.functions.scalar import register_sql_functions

    register_sql_functions(spark)
    ratings.createOrReplaceTempView("ratings")
    spark.sql("SELECT mid, score, changeDate(timestamp) AS yearmonth FROM ratings") \
        .createOrReplaceTempView("ratingCountByMonth")
