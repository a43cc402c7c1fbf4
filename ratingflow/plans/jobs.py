"""The six jobs, as functions over injected tables and sinks.

Each job takes DataFrames (or paths + formats) and a ``Params``; storage
formats and options are parameters, so the same plan writes parquet in
tests and a document store or search index through its Spark connector in
production.

  load_job        lines -> Movie, Rating, Tag tables + search documents
  statistics_job  Rating, Movie -> four statistics tables
  offline_job     Rating, Movie -> user recs (ALS) + movie similarity recs
  tuning_job      Rating -> RMSE of each grid point and the best one
  log_cleaning    raw log stream -> rating message stream   (streaming)
  rescoring       rating message stream -> per-user recs    (streaming)
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ratingflow import schemas
from ratingflow.operators import documents, model, similarity, stats
from ratingflow.operators.topk import nest
from ratingflow.params import Params
from ratingflow.session import set_time_zone
from ratingflow.sinks.history import EdgeTable, UserHistory
from ratingflow.sinks.tables import KeyedLog, write_search_documents, write_table
from ratingflow.sources.lines import read_lines
from ratingflow.sources.tables import read_table, to_edges
from ratingflow.streaming.log_cleaner import start_log_cleaner
from ratingflow.streaming.recommender import RescoreHandler, start_rescoring


@dataclass
class Store:
    """Where result tables go: ``{root}/{name}`` in ``fmt`` (or per-table
    options for connector formats that take a collection name instead of a
    path)."""

    root: str | None = None
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)
    table_options: dict = field(default_factory=dict)

    def path(self, name: str) -> str | None:
        return f"{self.root.rstrip('/')}/{name}" if self.root else None

    def write(self, df: DataFrame, name: str) -> None:
        opts = {**self.options, **self.table_options.get(name, {})}
        write_table(df, self.path(name), self.fmt, options=opts)

    def read(self, spark: SparkSession, name: str, schema=None) -> DataFrame:
        opts = {**self.options, **self.table_options.get(name, {})}
        return read_table(spark, self.path(name), schema, self.fmt, options=opts)


# fixed values: table names of the store
MOVIE, RATING, TAG = "Movie", "Rating", "Tag"
RATING_BY_USER = "RatingByUser"     # our own: the ratings with point access
RATE_COUNT, RATE_COUNT_MONTH, AVG_SCORE, GENRE_TOP = (
    "rateNumbersMovie", "rateNumberRecentMovie", "averageScoreMovies", "genresTopMovies")
USER_RECS, MOVIE_RECS, STREAM_RECS = "UserRecommandation", "MovieRecommandation", "StreamRecs"


def load_job(spark: SparkSession, movie_path: str, rating_path: str, tag_path: str,
             store: Store, docs: Store | None = None, sep: str = ",",
             mode: str = "strict", history_buckets: int | None = None) -> None:
    """Parse the three text files, overwrite the three tables, and build
    the search documents (movies with their '|'-joined distinct tags).
    With ``history_buckets`` the ratings are also written by user
    (``UserHistory``) for the stream's point reads."""
    movies = read_lines(spark, movie_path, "movie", sep, mode)
    ratings = read_lines(spark, rating_path, "rating", sep, mode)
    tags = read_lines(spark, tag_path, "tag", sep, mode)
    store.write(movies, MOVIE)
    store.write(ratings, RATING)
    store.write(tags, TAG)
    if history_buckets and store.path(RATING_BY_USER):
        UserHistory(store.path(RATING_BY_USER), history_buckets).load(store.read(spark, RATING, schemas.RATING))
    # documents from the written tables: the text is parsed once
    m = store.read(spark, MOVIE, schemas.MOVIE)
    t = store.read(spark, TAG, schemas.TAG)
    target = docs or Store(store.root and f"{store.root.rstrip('/')}/search", store.fmt)
    write_search_documents(documents.search_documents(m, t), target.path("Movie"), target.fmt,
                           target.options)


def statistics_job(spark: SparkSession, ratings: DataFrame, movies: DataFrame, store: Store,
                   params: Params = Params()) -> None:
    """Four statistics tables from ONE pass over the raw ratings.

    The (month, movie) rollup is the only aggregate of the raw table; the
    per-movie counts and averages roll up from it (it has at most
    movies x months rows), and the genre ranking reuses those averages.
    Only the small rollup is persisted, never the raw ratings.
    """
    set_time_zone(spark, params.time_zone)
    r = ratings.select("uid", "mid", "score", "timestamp")
    stats.register_views(spark, r)
    rollup = stats.movie_month_rollup(r).persist(StorageLevel.MEMORY_AND_DISK)
    per_movie = stats.per_movie_from_rollup(rollup).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store.write(rollup.select("mid", "count", "yearmonth"), RATE_COUNT_MONTH)
        store.write(per_movie.select("mid", "count"), RATE_COUNT)
        avg = per_movie.select("mid", "avg")
        store.write(avg, AVG_SCORE)
        mwa = stats.movies_with_average(movies.select("mid", "name", "genres"), avg)
        store.write(stats.genre_top_movies(mwa, params.genres, params.genre_k), GENRE_TOP)
    finally:
        per_movie.unpersist()
        rollup.unpersist()


def offline_job(spark: SparkSession, ratings: DataFrame, movies: DataFrame, store: Store,
                params: Params = Params()) -> None:
    """ALS fit, per-user top-k over the catalogue, and the item similarity
    table (cosine of item factors > threshold, every edge kept).

    The raw ratings are not cached here: ALS keeps its own blocked copy,
    and the factors it returns are cached by the model for both uses.
    """
    r = ratings.select("uid", "mid", "score")
    m = model.fit(r, params.rank, params.max_iter, params.reg, params.seed, params.als_blocks)
    top = model.model_user_top_k(m, movies, params.user_k,
                                 ratings=r if params.exclude_rated else None,
                                 block_rows=params.block_rows)
    store.write(nest(top, ["uid"], "pos", ["rid", "r"]), USER_RECS)
    edges = model.model_item_similarity(m, params.sim_threshold, params.block_rows)
    store.write(similarity.nest_edges(edges), MOVIE_RECS)


def tuning_job(spark: SparkSession, ratings: DataFrame, params: Params = Params()) -> DataFrame:
    """(rank, reg, rmse) of the grid, best first; ``model.best_params``
    picks the winning row."""
    return model.grid_search(spark, ratings, params.grid_ranks, params.grid_regs,
                             params.grid_iter, params.seed, params.holdout,
                             params.grid_parallelism)


def log_cleaning_job(spark: SparkSession, source_format: str, source_options: dict,
                     sink_format: str, sink_options: dict, checkpoint: str,
                     params: Params = Params()) -> StreamingQuery:
    return start_log_cleaner(spark, source_format, source_options, sink_format, sink_options,
                             checkpoint, trigger_seconds=params.trigger_seconds)


def rescoring_job(spark: SparkSession, messages: DataFrame,
                  history: UserHistory | DataFrame | Callable[[], DataFrame],
                  movie_recs: DataFrame, sink_path: str, checkpoint: str,
                  params: Params = Params(), available_now: bool = False) -> StreamingQuery:
    """Structured Streaming job: ``messages`` is the streaming DataFrame
    of the rating topic (column ``value``), ``movie_recs`` the nested
    similarity table written by ``offline_job``; ``history`` as a
    ``UserHistory`` is read by user (and then the edges by movie, from a table
    written beside the sink first), as a function anew for each batch."""
    edges = to_edges(movie_recs)
    if isinstance(history, UserHistory):
        by_movie = EdgeTable(f"{sink_path.rstrip('/')}_edges", history.files.buckets)
        by_movie.load(edges)
        edges = by_movie
    handler = RescoreHandler(history, edges, KeyedLog(sink_path, "uid"), params, with_string=True)
    return start_rescoring(spark, messages, handler, checkpoint, available_now,
                           params.trigger_seconds)


__all__ = ["Store", "load_job", "statistics_job", "offline_job", "tuning_job",
           "log_cleaning_job", "rescoring_job"]
