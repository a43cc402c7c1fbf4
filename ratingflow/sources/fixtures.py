"""Contract tables derived from the driver's test tables.

The test data is a TPC-H-like star schema; these projections turn it into
the Movie / Rating / Tag contract of the jobs.  Every function is a lazy
plan over the given parquet files, so the work grows with the data.

ratings : lineitem JOIN orders  -> (uid=o_custkey, mid=l_partkey,
          score=ceil(l_quantity/5)/2 in half-star steps, timestamp=shipdate)
movies  : part -> (mid=p_partkey, name=p_name, genres=p_type|name words)
tags    : events -> (uid=user_id, mid=props.k, tag=event_type, timestamp=ts)
log     : events -> raw log lines; purchases carry a rating message
vectors : embeddings -> (mid, features array<double>)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingflow.params import RATING_PREFIX


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5) / F.lit(2.0)).alias("score"),
        F.unix_timestamp("l_shipdate").cast("int").alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws("|", F.col("p_type"), F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))).alias("genres"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        F.col("event_type").alias("tag"),
        F.unix_timestamp("ts").cast("int").alias("timestamp"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, line): purchases become rating log lines, the rest noise."""
    e = _read(spark, sf_dir, "events")
    score = F.least(F.lit(5.0), F.greatest(F.lit(0.5), F.ceil(F.col("value") / 20) / F.lit(2.0)))
    msg = F.concat(
        F.lit(f"INFO {RATING_PREFIX} "), F.col("user_id").cast("string"), F.lit("|"),
        F.get_json_object("props", "$.k"), F.lit("|"), score.cast("string"), F.lit("|"),
        F.unix_timestamp("ts").cast("string"), F.lit(" "))
    line = F.when(F.col("event_type") == "purchase", msg).otherwise(
        F.concat(F.lit("INFO "), F.col("event_type")))
    return e.select("event_id", line.alias("line"))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _read(spark, sf_dir, "embeddings")
    return v.select(
        F.col("vec_id").cast("int").alias("mid"),
        F.transform("embedding", lambda x: x.cast("double")).alias("features"),
    )


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = ratings(spark, sf_dir)
    return r.select(F.concat_ws(",", *[F.col(c).cast("string") for c in r.columns]).alias("value"))


def movie_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = movies(spark, sf_dir)
    return m.select(F.concat_ws(",", F.col("mid").cast("string"), "name", "genres").alias("value"))


def tag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tags(spark, sf_dir)
    return t.select(F.concat_ws(",", *[F.col(c).cast("string") for c in t.columns]).alias("value"))


def profile_vectors(ratings_df: DataFrame, vectors_df: DataFrame) -> DataFrame:
    """(uid, features): score-weighted sum of the vectors of the movies a
    user rated - deterministic user factors for the factor top-k query.
    Spark ML's Summarizer is a partial-aggregating vector sum."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    j = ratings_df.select("uid", "mid", "score").join(vectors_df, "mid")
    s = j.groupBy("uid").agg(
        Summarizer.sum(array_to_vector("features"), F.col("score")).alias("s"))
    return s.select("uid", vector_to_array("s").alias("features"))
