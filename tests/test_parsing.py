"""Line readers, log payloads, rating messages, month key (FIXTURES §4)."""

import pytest
from pyspark.errors import PySparkException

from ratingflow.functions.scalar import log_payload, register_sql_functions, year_month
from ratingflow.sources.lines import parse_movie_lines, parse_rating_lines, read_lines
from ratingflow.streaming.log_cleaner import clean_log
from ratingflow.streaming.recommender import parse_messages


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_month_key_utc(spark):
    df = spark.createDataFrame([(1260759179,)], "ts int")
    assert df.select(year_month("ts")).first()[0] == 200912
    register_sql_functions(spark)
    assert spark.sql("SELECT changeDate(1260759179) AS m").first()["m"] == 200912


def test_month_key_month_end(spark):
    # 2009-12-31 23:59:59 UTC and one second later
    df = spark.createDataFrame([(1262303999,), (1262304000,)], "ts int")
    assert [r[0] for r in df.select(year_month("ts")).collect()] == [200912, 201001]


def test_comma_in_title_naive_split(spark):
    row = parse_movie_lines(lines(spark, "5,Father, Part II (1995),Comedy")).first()
    assert (row.mid, row.name, row.genres) == (5, "Father", "Part II (1995)")


def test_comma_in_title_quoted(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text('5,"Father, Part II (1995)",Comedy\n')
    row = read_lines(spark, str(p), "movie", mode="quoted").first()
    assert row.name == "Father, Part II (1995)" and row.genres == "Comedy"


def test_quoted_mode_extra_and_short_lines(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text('1,31,2.5,1260759144,x\n5,6\n"7",8,1.0,9\n')
    rows = sorted(tuple(r) for r in read_lines(spark, str(p), "rating", mode="quoted").collect())
    assert rows == [(1, 31, 2.5, 1260759144), (7, 8, 1.0, 9)]


def test_short_line_strict_fails(spark):
    with pytest.raises(PySparkException):
        parse_movie_lines(lines(spark, "5,Heat")).collect()


def test_short_line_drop_mode(spark):
    assert parse_movie_lines(lines(spark, "5,Heat", "6,X,Y"), mode="drop").count() == 1


def test_bad_number_strict_fails_and_drop_skips(spark):
    df = lines(spark, "1,x,2.5,1260759144", "1,31,2.5,1260759144")
    with pytest.raises(PySparkException):
        parse_rating_lines(df).collect()
    assert parse_rating_lines(df, mode="drop").count() == 1


def test_extra_field_ignored(spark):
    row = parse_rating_lines(lines(spark, "1,31,2.5,1260759144,x")).first()
    assert tuple(row) == (1, 31, 2.5, 1260759144)


def test_movie_fields_trimmed(spark):
    row = parse_movie_lines(lines(spark, " 7 , Heat ,Action ")).first()
    assert tuple(row) == (7, "Heat", "Action")


def test_caret_separator(spark):
    row = parse_movie_lines(lines(spark, "7^Heat, The^Action|Crime"), sep="^").first()
    assert tuple(row) == (7, "Heat, The", "Action|Crime")


@pytest.mark.parametrize("line,expected", [
    ("x MOVIE_RATING_PREFIX: 1|2|3.5|1260759179 ", "1|2|3.5|1260759179"),
    ("MOVIE_RATING_PREFIX:a MOVIE_RATING_PREFIX:b", "a"),
    ("MOVIE_RATING_PREFIX:\t1|2|3|4\n", "1|2|3|4"),
])
def test_log_payload(spark, line, expected):
    assert lines(spark, line).select(log_payload("value")).first()[0] == expected


def test_log_cleaner_drops_noise_and_bare_prefix(spark):
    df = lines(spark, "INFO click", "MOVIE_RATING_PREFIX:", "MOVIE_RATING_PREFIX:   ",
               "y MOVIE_RATING_PREFIX:1|2|3|4")
    out = clean_log(df).collect()
    assert [(r.key, r.value) for r in out] == [("logProcessor", "1|2|3|4")]


def test_log_cleaner_binary_value(spark):
    df = spark.createDataFrame([(bytearray(b"a MOVIE_RATING_PREFIX: 1|2|3|4"),)], "value binary")
    assert clean_log(df).first().value == "1|2|3|4"


def test_message_parse_drop_mode_counts(spark):
    df = lines(spark, "1|2|3.5|100", "bad", "1|x|3|4", "4|5|1.0|7|extra")
    out = parse_messages(df).orderBy("uid").collect()
    assert [tuple(r) for r in out] == [(1, 2, 3.5, 100), (4, 5, 1.0, 7)]


def test_message_parse_strict_fails(spark):
    from ratingflow.functions.scalar import parse_message_fields
    with pytest.raises(PySparkException):
        lines(spark, "1|2").select(*parse_message_fields("value", strict=True)).collect()


def test_genres_substring_case_insensitive(spark):
    from ratingflow.operators import stats
    mwa = spark.createDataFrame([(1, "a", "SMALL|ring", 4.0), (2, "b", "large|smallish", 3.0),
                                 (3, "c", "bolt", 5.0)], "mid int, name string, genres string, avg double")
    out = stats.genre_top_exploded(mwa, ["small", "Ring"], k=10).orderBy("genres", "pos").collect()
    assert [(r.genres, r.rid) for r in out] == [("Ring", 1), ("small", 1), ("small", 2)]


def test_genre_top_k_ties_by_mid(spark):
    from ratingflow.operators import stats
    rows = [(i, "n", "red", 3.0) for i in range(15, 0, -1)]
    mwa = spark.createDataFrame(rows, "mid int, name string, genres string, avg double")
    nested = stats.genre_top_movies(mwa, ["red"], k=10).first()
    assert [x.rid for x in nested.recs] == list(range(1, 11))


def test_strict_mode_fails_without_ansi(spark):
    from ratingflow.functions.scalar import parse_message_fields
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException):
            parse_rating_lines(lines(spark, "1,x,2.5,1260759144")).collect()
        with pytest.raises(PySparkException):
            lines(spark, "1|2|abc|4").select(*parse_message_fields("value", strict=True)).collect()
        assert parse_rating_lines(lines(spark, "1,31,2.5,1260759144")).count() == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_params_validation():
    from ratingflow.params import Params
    assert Params().with_(recent_k=5).recent_k == 5
    for bad in (dict(recent_k=0), dict(sim_threshold=float("nan")), dict(holdout=1.0),
                dict(history_buckets=0)):
        with pytest.raises(ValueError):
            Params(**bad)


def test_movie_lines_trim_like_java_and_short_lines_fail(spark):
    import pytest
    from pyspark.errors import PySparkException

    lines = spark.createDataFrame([("5,\tHeat\t,\x01Action ",)], "value string")
    assert tuple(parse_movie_lines(lines).first()) == (5, "Heat", "Action")
    for bad in ("5,Heat,", "5,Heat", "x,Heat,Action"):
        with pytest.raises(PySparkException):
            parse_movie_lines(spark.createDataFrame([(bad,)], "value string")).collect()
        assert parse_movie_lines(spark.createDataFrame([(bad,)], "value string"), mode="drop").collect() == []


def test_quoted_strict_fails_on_bad_rows(spark, tmp_path):
    import pytest
    from pyspark.errors import PySparkException

    from ratingflow.sources.lines import line_counts, read_lines
    path = tmp_path / "movies.csv"
    path.write_text('1,"Heat, the film",Action\n2,Empty,\nx,Bad,Drama\n')
    assert [tuple(r) for r in read_lines(spark, str(path), "movie", mode="quoted").collect()] == \
        [(1, "Heat, the film", "Action")]
    with pytest.raises(PySparkException):
        read_lines(spark, str(path), "movie", mode="quoted_strict").collect()
    counts = line_counts(spark.read.text(str(path)), "movie").first()
    assert (counts.n_lines, counts.n_dropped) == (3, 2)     # a plain split takes the quoted one, cut


def test_different_vectors_of_one_id_fail(spark):
    import pytest
    from pyspark.errors import PySparkException

    from ratingflow.operators.similarity import item_similarity
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "mid int, features array<double>")
    with pytest.raises(PySparkException, match="different vectors"):
        item_similarity(rows, 0.1).collect()
