"""The jobs end to end on sf0.001, chained through a parquet Store."""

import os

import pytest
from pyspark.sql import functions as F

from ratingflow import schemas
from ratingflow.params import Params
from ratingflow.plans import jobs
from ratingflow.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    text = root / "text"
    fx.movie_lines(spark, SF).write.text(str(text / "movies"))
    fx.rating_lines(spark, SF).write.text(str(text / "ratings"))
    fx.tag_lines(spark, SF).write.text(str(text / "tags"))
    st = jobs.Store(str(root / "db"))
    jobs.load_job(spark, str(text / "movies"), str(text / "ratings"), str(text / "tags"), st)
    return st


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_load_job_tables(spark, store):
    assert _same(store.read(spark, jobs.RATING, schemas.RATING), fx.ratings(spark, SF))
    assert _same(store.read(spark, jobs.MOVIE, schemas.MOVIE), fx.movies(spark, SF))
    assert _same(store.read(spark, jobs.TAG, schemas.TAG), fx.tags(spark, SF))
    docs = spark.read.parquet(store.root + "/search/Movie")
    assert docs.count() == fx.movies(spark, SF).count()
    assert docs.select("mid").distinct().count() == docs.count()
    tagged = docs.where(F.col("tags").isNotNull()).first()
    parts = tagged.tags.split("|")
    assert parts == sorted(set(parts))


def test_statistics_job(spark, store):
    r = store.read(spark, jobs.RATING, schemas.RATING)
    m = store.read(spark, jobs.MOVIE, schemas.MOVIE)
    params = Params(genres=("red", "small", "Anvil", "nomatch"))
    jobs.statistics_job(spark, r, m, store, params)
    counts = store.read(spark, jobs.RATE_COUNT)
    monthly = store.read(spark, jobs.RATE_COUNT_MONTH)
    assert counts.agg(F.sum("count")).first()[0] == r.count()
    assert monthly.agg(F.sum("count")).first()[0] == r.count()
    assert set(monthly.columns) == {"mid", "count", "yearmonth"}
    avg = store.read(spark, jobs.AVG_SCORE)
    assert avg.count() == r.select("mid").distinct().count()
    genres = {row.genres: row.recs for row in store.read(spark, jobs.GENRE_TOP).collect()}
    assert set(genres) == {"red", "small", "Anvil"}       # no row for a genre without movies
    for recs in genres.values():
        assert 0 < len(recs) <= 10
        keys = [(-x.r, x.rid) for x in recs]
        assert keys == sorted(keys)
    # SQL surface of the statistics job
    assert spark.sql("SELECT count(*) FROM ratingCountByMonth").first()[0] == r.count()


def test_offline_job(spark, store):
    r = store.read(spark, jobs.RATING, schemas.RATING)
    m = store.read(spark, jobs.MOVIE, schemas.MOVIE)
    params = Params(rank=6, max_iter=4, reg=0.1, sim_threshold=0.6, block_rows=64)
    jobs.offline_job(spark, r, m, store, params)
    users = store.read(spark, jobs.USER_RECS).collect()
    assert len(users) == r.select("uid").distinct().count()
    assert all(len(u.recs) == 20 and len({x.rid for x in u.recs}) == 20 for u in users)
    sims = store.read(spark, jobs.MOVIE_RECS)
    edges = sims.select("mid", F.inline("recs"))
    assert edges.where("r <= 0.6 OR mid = rid").count() == 0
    # symmetric
    e = edges.select("mid", "rid")
    assert e.exceptAll(e.select(F.col("rid").alias("mid"), F.col("mid").alias("rid"))).count() == 0


def test_tuning_job(spark, store):
    r = store.read(spark, jobs.RATING, schemas.RATING)
    grid = jobs.tuning_job(spark, r, Params(grid_ranks=(2, 3), grid_regs=(0.1,), grid_iter=2))
    rows = grid.collect()
    assert [x.rank for x in rows] and rows[0].rmse == min(x.rmse for x in rows)


def test_rescoring_job_stream(spark, store, tmp_path):
    r = store.read(spark, jobs.RATING, schemas.RATING)
    # a similarity table with edges: cosine of the test vectors at 0.2
    from ratingflow.operators.similarity import item_similarity, nest_edges
    movie_recs = nest_edges(item_similarity(fx.item_vectors(spark, SF), 0.2))
    src = tmp_path / "in"
    spark.createDataFrame([("5|10|4.0|100",), ("5|11|4.0|200",), ("bad message",),
                           ("7|12|2.0|50",)], "value string").write.text(str(src))
    stream = spark.readStream.format("text").load(str(src))
    q = jobs.rescoring_job(spark, stream, r, movie_recs, str(tmp_path / "recs"),
                           str(tmp_path / "ck"), Params(score_threshold=0.2), available_now=True)
    q.awaitTermination()
    from ratingflow.sinks.tables import KeyedLog
    out = {row.uid: row for row in KeyedLog(str(tmp_path / "recs")).current(spark).collect()}
    assert set(out) == {5, 7}
    for row in out.values():
        assert row.recs_string == "|".join(f"{x.rid}:{x.r}" for x in row.recs)


def test_command_line_jobs(spark, tmp_path):
    from ratingflow.__main__ import main
    text = tmp_path / "text"
    fx.movie_lines(spark, SF).write.text(str(text / "m"))
    fx.rating_lines(spark, SF).write.text(str(text / "r"))
    fx.tag_lines(spark, SF).write.text(str(text / "t"))
    db = str(tmp_path / "db")
    assert main(["load", "--db", db, "--movies", str(text / "m"), "--ratings", str(text / "r"),
                 "--tags", str(text / "t"), "--history-buckets", "8"]) == 0
    assert "ub" not in spark.read.parquet(db + "/" + jobs.RATING).columns
    by_user = jobs.UserHistory(db + "/" + jobs.RATING_BY_USER, 8).rows(spark).select("uid", "mid", "score", "timestamp")
    assert _same(by_user, spark.read.parquet(db + "/" + jobs.RATING).select("uid", "mid", "score", "timestamp"))
    assert main(["statistics", "--db", db, "--genres", "red,small"]) == 0
    assert main(["offline", "--db", db, "--rank", "4", "--iter", "2", "--threshold", "0.9"]) == 0
    top = spark.read.parquet(db + "/" + jobs.GENRE_TOP)
    assert {r.genres for r in top.collect()} == {"red", "small"}
    assert spark.read.parquet(db + "/" + jobs.USER_RECS).count() == \
        fx.ratings(spark, SF).select("uid").distinct().count()
    # stream re-scoring from a file source, once
    src = tmp_path / "msgs"
    spark.createDataFrame([("1|10|4.0|100",)], "value string").write.text(str(src))
    assert main(["rescore", "--db", db, "--source-format", "text", "--source-option",
                 f"path={src}", "--sink", str(tmp_path / "recs"), "--checkpoint",
                 str(tmp_path / "ck"), "--threshold", "0.9", "--available-now",
                 "--history-buckets", "8"]) == 0
    from ratingflow.sinks.tables import KeyedLog
    assert [r.uid for r in KeyedLog(str(tmp_path / "recs")).current(spark).collect()] == [1]


def test_store_with_per_table_options(spark, tmp_path):
    """Connector-style store: no root path, each table named by options
    (as a document-store connector takes a collection name)."""
    st = jobs.Store(root=None, fmt="parquet",
                    table_options={jobs.MOVIE: {"path": str(tmp_path / "coll_movie")}})
    m = fx.movies(spark, SF)
    st.write(m, jobs.MOVIE)
    back = st.read(spark, jobs.MOVIE, schemas.MOVIE)
    assert _same(back, m)


def test_search_documents_one_per_movie(spark, tmp_path):
    from ratingflow.sinks.tables import write_search_documents
    docs = spark.createDataFrame([(1, "b", "x", None), (1, "a", "y", "t1"), (2, "c", "z", "t2")],
                                 "mid int, name string, genres string, tags string")
    write_search_documents(docs, str(tmp_path / "docs"))
    out = sorted(map(tuple, spark.read.parquet(str(tmp_path / "docs")).collect()))
    assert out == [(1, "a", "y", "t1"), (2, "c", "z", "t2")]


def test_command_line_tune(spark, tmp_path, capsys):
    from ratingflow.__main__ import main
    db = str(tmp_path / "db")
    st = jobs.Store(db)
    st.write(fx.ratings(spark, SF), jobs.RATING)
    assert main(["tune", "--db", db, "--grid-ranks", "2,3", "--grid-regs", "0.1",
                 "--grid-iter", "2", "--grid-parallelism", "2"]) == 0
    out = capsys.readouterr().out
    assert "rank" in out and "rmse" in out


def test_compact_keeps_all_rows_of_a_key(spark, tmp_path):
    from ratingflow.sinks.tables import KeyedLog
    log = KeyedLog(str(tmp_path / "lists"), key=["uid", "salt"])
    log.write_batch(spark.createDataFrame([(1, 0, i) for i in range(5)], "uid int, salt int, mid int"), 0)
    log.write_batch(spark.createDataFrame([(2, 0, i) for i in range(3)], "uid int, salt int, mid int"), 1)
    before = sorted(map(tuple, log.current_rows(spark).collect()))
    assert log.compact(spark) == 1 and len(before) == 8
    assert sorted(map(tuple, log.current_rows(spark).collect())) == before


class _Context:
    """Stands in for a cluster's context."""

    def __init__(self, master, held=None):
        self.master, self.applicationId, self.held = master, f"app-{id(self)}", held

    def getCheckpointDir(self):
        return self.held

    def setCheckpointDir(self, path):
        self.held = f"{path}/own"


class _Session:
    def __init__(self, context, **conf):
        self.sparkContext, values = context, dict(conf)

        class Conf:
            get = staticmethod(lambda k, d=None: values.get(k, d))
            set = staticmethod(values.__setitem__)
        self.conf = Conf


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    import pytest

    from ratingflow.session import ensure_checkpoint_dir
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(_Session(_Context(master)))
    assert ensure_checkpoint_dir(_Session(_Context("yarn"), **{"spark.checkpoint.dir": "hdfs:///x"})) == "hdfs:///x"


def test_the_contexts_checkpoint_folder_counts_first():
    from ratingflow.session import ensure_checkpoint_dir
    session = _Session(_Context("yarn", "hdfs:///mine/1"), **{"spark.checkpoint.dir": "hdfs:///other"})
    assert ensure_checkpoint_dir(session) == "hdfs:///mine/1" == ensure_checkpoint_dir(session)
    fresh = _Session(_Context("yarn"), **{"spark.checkpoint.dir": "hdfs:///x"})
    assert ensure_checkpoint_dir(fresh) == ensure_checkpoint_dir(fresh) == "hdfs:///x"


def test_scratch_folders_can_be_removed(spark):
    import os

    import pytest

    from ratingflow.session import remove_scratch, scratch_path
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    remove_scratch(spark, path)
    assert not os.path.isdir(local)
    with pytest.raises(ValueError):
        remove_scratch(spark, "/tmp/elsewhere")


def test_scratch_goes_when_the_driver_ends(tmp_path):
    """What a query leaves under the shared folder is deleted; the folder and
    what others keep there stay."""
    import subprocess
    import sys
    from tests.conftest import ROOT
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
from ratingflow.session import scratch_path
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false") \\
    .config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
spark.range(3).write.parquet(scratch_path(spark, "left"))
spark.range(3).write.parquet({str(tmp_path / "shared" / "kept")!r})
print(scratch_path(spark, "x"))
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "/ratingflow/" in done.stdout
    assert (tmp_path / "shared" / "kept").is_dir()
    own = done.stdout.strip().splitlines()[-1].removeprefix("file:").rsplit("/", 1)[0]
    assert own.startswith(str(tmp_path / "shared")) and not os.path.exists(own)
