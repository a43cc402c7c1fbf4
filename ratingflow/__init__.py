"""ratingflow: rating analytics and recommendation on Spark DataFrames.

Layout
------
sources/    readers: delimited lines, typed tables, test-table fixtures
sinks/      table writers, keyed replace, versioned stream state
functions/  column expressions (month key, message parsing, log payload, ...)
operators/  DataFrame -> DataFrame building blocks (statistics, documents,
            top-k, blocked vector products, similarity, ALS, stream scoring)
plans/      the jobs (load, statistics, offline model, tuning) and the
            named queries used by ``__spark_entry__``
streaming/  Structured Streaming wrappers (log cleaner, rating re-scorer,
            recent-list state)

Typical use::

    from ratingflow import Params, jobs
    store = jobs.Store("/data/db")
    jobs.statistics_job(spark, store.read(spark, jobs.RATING), store.read(spark, jobs.MOVIE),
                        store, Params())
"""

from ratingflow.params import Params

__version__ = "0.1.0"
__all__ = ["Params", "jobs", "__version__"]


def __getattr__(name):
    # ``ratingflow.jobs`` without importing pyspark-heavy modules up front
    if name == "jobs":
        from ratingflow.plans import jobs
        return jobs
    raise AttributeError(name)
