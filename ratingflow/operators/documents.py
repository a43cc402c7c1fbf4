"""Search documents: movies with their distinct tags joined by '|'.

Tags are de-duplicated on (mid, tag) first: that aggregate is keyed by the
pair, so a movie with a third of all tag rows is spread over many reducers
and combined map-side; the second aggregate then only sees distinct pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingflow.params import MESSAGE_SEP


def tag_strings(tags: DataFrame, sep: str = MESSAGE_SEP) -> DataFrame:
    """(mid, tags): distinct tags of each movie, sorted, joined by ``sep``."""
    pairs = tags.select("mid", "tag").where(F.col("tag").isNotNull()).distinct()
    return pairs.groupBy("mid").agg(
        F.concat_ws(sep, F.array_sort(F.collect_list("tag"))).alias("tags"))


def search_documents(movies: DataFrame, tags: DataFrame, sep: str = MESSAGE_SEP) -> DataFrame:
    """(mid, name, genres, tags): one row per movie; tags null if untagged."""
    return movies.join(tag_strings(tags, sep), "mid", "left").select("mid", "name", "genres", "tags")
