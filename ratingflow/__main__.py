"""Command line for the jobs (run under spark-submit or plain python).

  python -m ratingflow load        --movies P --ratings P --tags P --db ROOT
  python -m ratingflow statistics  --db ROOT
  python -m ratingflow offline     --db ROOT
  python -m ratingflow tune        --db ROOT
  python -m ratingflow clean-log   --source-format kafka --source-option subscribe=abc ...
                                   --sink-format kafka --sink-option topic=recommender ...
                                   --checkpoint P
  python -m ratingflow rescore     --db ROOT --source-format kafka --source-option ...
                                   --sink P --checkpoint P

Tables live under ``--db`` in ``--format`` (parquet by default); any Spark
data source works (``--option k=v`` is passed to it).  The session comes
from the environment (spark-submit settings); the shared checkpoint folder
is ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from ratingflow import schemas
from ratingflow.params import Params


def _kv(items):
    out = {}
    for it in items or []:
        k, _, v = it.partition("=")
        out[k] = v
    return out


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ratingflow")
    sub = p.add_subparsers(dest="job", required=True)

    def store_args(sp):
        sp.add_argument("--db", required=True, help="root folder of the tables")
        sp.add_argument("--format", default="parquet")
        sp.add_argument("--option", action="append", help="k=v option of the table format")

    sp = sub.add_parser("load")
    store_args(sp)
    for name in ("movies", "ratings", "tags"):
        sp.add_argument(f"--{name}", required=True)
    sp.add_argument("--sep", default=",")
    sp.add_argument("--mode", default="strict", choices=["strict", "drop", "quoted"])
    sp.add_argument("--history-buckets", type=int,
                    help="also write the ratings by user, in so many buckets, for the stream")

    sp = sub.add_parser("statistics")
    store_args(sp)
    sp.add_argument("--genres", help="comma separated genre list")
    sp.add_argument("--time-zone", default="UTC")

    for name in ("offline", "tune"):
        sp = sub.add_parser(name)
        store_args(sp)
        sp.add_argument("--rank", type=int, default=Params.rank)
        sp.add_argument("--iter", type=int, default=Params.max_iter)
        sp.add_argument("--reg", type=float, default=Params.reg)
        sp.add_argument("--threshold", type=float, default=Params.sim_threshold)
        sp.add_argument("--als-blocks", type=int)
        sp.add_argument("--holdout", type=float, default=0.0)
        sp.add_argument("--grid-parallelism", type=int, default=1)
        sp.add_argument("--grid-ranks", help="comma separated ranks (tune)")
        sp.add_argument("--grid-regs", help="comma separated regularisations (tune)")
        sp.add_argument("--grid-iter", type=int, default=Params.grid_iter)

    sp = sub.add_parser("clean-log")
    for side in ("source", "sink"):
        sp.add_argument(f"--{side}-format", required=True)
        sp.add_argument(f"--{side}-option", action="append")
    sp.add_argument("--checkpoint", required=True)

    sp = sub.add_parser("rescore")
    store_args(sp)
    sp.add_argument("--source-format", required=True)
    sp.add_argument("--source-option", action="append")
    sp.add_argument("--sink", required=True, help="folder of the StreamRecs keyed log")
    sp.add_argument("--checkpoint", required=True)
    sp.add_argument("--threshold", type=float, default=Params.score_threshold)
    sp.add_argument("--history-buckets", type=int, help="read the ratings by user, as load wrote them")
    sp.add_argument("--compact-every", type=int, help="snapshot the recs every N batches")
    sp.add_argument("--recent-k", type=int, default=Params.recent_k)
    sp.add_argument("--cand-k", type=int, default=Params.cand_k)
    sp.add_argument("--append-history", action="store_true", help="the stream's messages join the history")
    sp.add_argument("--trigger-seconds", type=int, default=Params.trigger_seconds)
    sp.add_argument("--available-now", action="store_true")
    return p


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from ratingflow.plans import jobs
    from ratingflow.session import ensure_checkpoint_dir

    spark = SparkSession.builder.appName(f"ratingflow-{args.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    store = jobs.Store(args.db, args.format, _kv(args.option)) if hasattr(args, "db") else None

    if args.job == "load":
        jobs.load_job(spark, args.movies, args.ratings, args.tags, store, sep=args.sep,
                      mode=args.mode, history_buckets=args.history_buckets)
    elif args.job == "statistics":
        params = Params(time_zone=args.time_zone)
        if args.genres:
            params = params.with_(genres=tuple(g.strip() for g in args.genres.split(",")))
        jobs.statistics_job(spark, store.read(spark, jobs.RATING, schemas.RATING),
                            store.read(spark, jobs.MOVIE, schemas.MOVIE), store, params)
    elif args.job in ("offline", "tune"):
        params = Params(rank=args.rank, max_iter=args.iter, reg=args.reg,
                        sim_threshold=args.threshold, als_blocks=args.als_blocks,
                        holdout=args.holdout, grid_parallelism=args.grid_parallelism,
                        grid_iter=args.grid_iter)
        if args.grid_ranks:
            params = params.with_(grid_ranks=tuple(int(x) for x in args.grid_ranks.split(",")))
        if args.grid_regs:
            params = params.with_(grid_regs=tuple(float(x) for x in args.grid_regs.split(",")))
        ratings = store.read(spark, jobs.RATING, schemas.RATING)
        if args.job == "offline":
            jobs.offline_job(spark, ratings, store.read(spark, jobs.MOVIE, schemas.MOVIE), store, params)
        else:
            from ratingflow.operators.model import best_params
            best_params(jobs.tuning_job(spark, ratings, params)).show(truncate=False)
    elif args.job == "clean-log":
        q = jobs.log_cleaning_job(spark, args.source_format, _kv(args.source_option),
                                  args.sink_format, _kv(args.sink_option), args.checkpoint)
        q.awaitTermination()
    elif args.job == "rescore":
        params = Params(score_threshold=args.threshold, history_buckets=args.history_buckets,
                        compact_every=args.compact_every, recent_k=args.recent_k, cand_k=args.cand_k,
                        append_history=args.append_history, trigger_seconds=args.trigger_seconds)
        source = spark.readStream.format(args.source_format).options(**_kv(args.source_option)).load()
        if "value" in source.columns:
            source = source.selectExpr("CAST(value AS STRING) AS value")
        history = lambda: store.read(spark, jobs.RATING)
        if args.history_buckets:
            history = jobs.UserHistory(store.path(jobs.RATING_BY_USER), args.history_buckets)
        q = jobs.rescoring_job(spark, source, history,
                               store.read(spark, jobs.MOVIE_RECS), args.sink, args.checkpoint,
                               params, available_now=args.available_now)
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
