"""The facts that queries return instead of values fail when the result is spoilt."""

import pytest
from pyspark.sql import functions as F

from ratingflow.functions.scalar import parse_list_item
from ratingflow.operators.blocked import cosine_edges, top_k_products
from ratingflow.plans import queries as q
from ratingflow.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_a_left_out_movie_is_missed(spark):
    items = fx.item_vectors(spark, SF)
    users = fx.profile_vectors(fx.ratings(spark, SF), items)
    users = users.withColumn("uid", F.col("uid") * 50).checkpoint()
    top = top_k_products(users, items, 20, left_id="uid", right_id="mid").checkpoint()
    good = q.missed_recs(top, users, items)
    assert good.count() == users.count() and good.where("n_missed != 0").isEmpty()
    # the third best replaced by the worst of all
    worst = top_k_products(users.select("uid", F.transform("features", lambda x: -x).alias("features")), items, 1,
                           left_id="uid", right_id="mid").select("uid", F.col("rid").alias("w"), F.col("r").alias("wr"))
    bad = top.join(worst, "uid").select("uid", "pos", F.when(F.col("pos") == 3, F.col("w")).otherwise(F.col("rid")).alias("rid"),
                                        F.when(F.col("pos") == 3, -F.col("wr")).otherwise(F.col("r")).alias("r"))
    assert q.missed_recs(bad, users, items).where("n_missed = 0").isEmpty()
    assert not q.missed_recs(top.where("pos != 5"), users, items).where("n_missed > 0").isEmpty()


def test_a_left_out_or_invented_edge_is_seen(spark):
    items = fx.item_vectors(spark, SF)
    edges = cosine_edges(items, 0.3).checkpoint()
    assert q.missed_edges(edges, items, 0.3).first() == (0, 0)
    some = edges.where("mid % 50 = 0").first()
    gone = edges.where(f"not (mid = {some.mid} and rid = {some.rid})")
    assert q.missed_edges(gone, items, 0.3).first() == (1, 0)
    assert q.missed_edges(edges.where("rid % 2 = 0"), items, 0.3).first()[0] > 0
    more = edges.union(spark.createDataFrame([(some.mid, 10 ** 6, 0.9)], "mid int, rid int, r double"))
    assert q.missed_edges(more, items, 0.3).first() == (0, 1)


@pytest.mark.parametrize("column", ["uid", "mid", "score", "timestamp"])
def test_every_stored_column_counts(spark, column):
    ratings = fx.ratings(spark, SF)
    good = q.stored_checksum(ratings, "Rating").first()
    spoilt = ratings.withColumn(column, F.when(F.col("uid") % 7 == 0, F.lit(0)).otherwise(F.col(column)).cast(dict(ratings.dtypes)[column]))
    bad = q.stored_checksum(spoilt, "Rating").first()
    assert bad.n == good.n and bad.checksum != good.checksum


def test_items_of_a_recent_list(spark):
    rows = [("31|2.5", 31, 2.5), (" 31 |\t2.5\n", 31, 2.5), ("31:2.5", None, None), ("31", 31, None), ("x|1", None, 1.0),
            ("", None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "item string, mid int, score double")
    for r in df.select("item", "mid", "score", F.struct(*parse_list_item("item")).alias("got")).collect():
        assert tuple(r.got) == (r.mid, r.score), r.item
    colon = df.limit(1).select(F.lit(" 7 : 4.5").alias("item")).select(*parse_list_item("item", sep=":")).first()
    assert tuple(colon) == (7, 4.5)
