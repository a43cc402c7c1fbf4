"""Scalar column functions.

All of them build Catalyst expressions, so they stay inside whole-stage
codegen; none calls back into Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ratingflow.params import MESSAGE_SEP, RATING_PREFIX


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_on(col: Column | str, sep: str) -> Column:
    """Split on a literal separator (not a regex)."""
    return F.split(_c(col), re.escape(sep))


def split_fields(col: Column | str, sep: str) -> Column:
    """Split on a literal separator, without the empty fields at the end:
    the separators that end the text are cut first."""
    text = _c(col)
    if len(sep) == 1:
        return split_on(F.rtrim(text, F.lit(sep)), sep)
    return split_on(F.regexp_replace(text, f"(?:{re.escape(sep)})+$", ""), sep)


_CONTROL_AND_SPACE = "".join(chr(i) for i in range(0x21))


def java_trim(col: Column | str) -> Column:
    """Trim every char <= U+0020 on both ends (java.lang.String.trim);
    ``btrim`` with an explicit character set, no regex."""
    return F.btrim(_c(col), F.lit(_CONTROL_AND_SPACE))


def year_month(epoch_seconds: Column | str) -> Column:
    """Epoch seconds -> INT yyyyMM in the session time zone.

    Integer arithmetic on year()/month() instead of formatting a string;
    e.g. 1260759179 -> 200912 under UTC.
    """
    ts = F.timestamp_seconds(_c(epoch_seconds))
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def bounded_log2(n: Column | str) -> Column:
    """log2(max(n, 1)): a missing like/dislike side contributes 0."""
    return F.log2(F.greatest(_c(n), F.lit(1)).cast("double"))


def log_payload(line: Column | str, prefix: str = RATING_PREFIX) -> Column:
    """Text between the first and second ``prefix`` of a log line, trimmed.

    Null when the line has no prefix; '' when nothing follows it (callers
    drop both).
    """
    line = _c(line)
    part = F.split_part(line, F.lit(prefix), F.lit(2))
    return F.when(line.contains(prefix), java_trim(part))


def parse_message_fields(msg: Column | str, strict: bool = True,
                         sep: str = MESSAGE_SEP) -> list[Column]:
    """``UID|MID|SCORE|TIMESTAMP`` -> [uid INT, mid INT, score DOUBLE, ts INT].

    strict: a short message or a bad number raises (ANSI cast);
    otherwise the bad field becomes null and the caller filters.
    """
    parts = split_on(msg, sep)
    types = ("int", "int", "double", "int")
    names = ("uid", "mid", "score", "timestamp")
    out = []
    for i, (t, n) in enumerate(zip(types, names)):
        if strict:
            err = F.raise_error(F.concat(F.lit("malformed rating message: "),
                                         F.coalesce(_c(msg), F.lit("null"))))
            field = F.when(F.size(parts) > i, parts[i]).otherwise(err)
            # fail on a bad number whatever the session's ANSI setting
            out.append(F.when(field.try_cast(t).isNull(), err)
                       .otherwise(field.try_cast(t)).alias(n))
        else:
            out.append(F.get(parts, i).try_cast(t).alias(n))
    return out


def parse_list_item(item: Column | str, sep: str = MESSAGE_SEP) -> list[Column]:
    """One item ``mid|score`` of a stored list -> [mid INT, score DOUBLE];
    both fields are trimmed; a short or bad item gives nulls."""
    parts = split_on(item, sep)
    return [java_trim(F.get(parts, 0)).try_cast("int").alias("mid"),
            java_trim(F.get(parts, 1)).try_cast("double").alias("score")]


def recs_to_string(recs: Column | str) -> Column:
    """array<struct<rid,r>> -> 'rid:r|rid:r' (stream rec string form)."""
    return F.array_join(
        F.transform(_c(recs), lambda x: F.concat(x["rid"].cast("string"), F.lit(":"),
                                                 x["r"].cast("string"))),
        MESSAGE_SEP)


def register_sql_functions(spark: SparkSession) -> None:
    """Expose ``changeDate(ts INT) -> INT yyyyMM`` to SQL.

    A SQL function (not a Python UDF): Catalyst inlines its body, so it
    folds and codegens like a native expression.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION changeDate(ts INT) RETURNS INT "
        "RETURN CAST(year(timestamp_seconds(ts)) * 100 + month(timestamp_seconds(ts)) AS INT)")
