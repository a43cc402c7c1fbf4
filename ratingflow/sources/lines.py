"""Delimited line readers for movies, ratings and tags.

The input files are plain text with no quoting: each line is split on a
separator and the first fields are cast.  A title that holds the separator
is cut, exactly like a naive split; use ``mode='quoted'`` for CSV quoting.

Modes
-----
strict  (default) a short line or a bad number fails the job
drop    such lines are dropped (``get`` + ``try_cast``); ``line_counts``
        tells how many
quoted  the CSV reader with quote handling (only via ``read_lines``);
        extra fields ignored, incomplete rows dropped; ``quoted_strict``
        fails on them instead

Empty fields at the end of a line don't count, so a line whose last field is
empty is short.

All parsers take a DataFrame with one string column ``value`` (what
``spark.read.text`` returns), so they work the same on files and on lines
built from other tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingflow import schemas
from ratingflow.functions.scalar import java_trim, split_fields

_SPECS = {
    # kind: ((name, type, trim), ...)
    "movie": (("mid", "int", True), ("name", "string", True), ("genres", "string", True)),
    "rating": (("uid", "int", False), ("mid", "int", False),
               ("score", "double", False), ("timestamp", "int", False)),
    "tag": (("uid", "int", False), ("mid", "int", False),
            ("tag", "string", False), ("timestamp", "int", False)),
}


def _parse(lines: DataFrame, kind: str, sep: str, mode: str) -> DataFrame:
    spec = _SPECS[kind]
    parts = split_fields(F.col("value"), sep)
    cols: list[Column] = []
    for i, (name, typ, trim) in enumerate(spec):
        if mode == "strict":
            raw = F.when(F.size(parts) > i, parts[i]).otherwise(
                F.raise_error(F.concat(F.lit(f"short {kind} line: "), F.col("value"))))
        elif mode == "drop":
            raw = F.get(parts, i)
        else:
            raise ValueError(f"unknown mode {mode!r}")
        if trim:
            raw = java_trim(raw)
        if typ == "string":
            val = raw
        elif mode == "strict":
            # fail on a bad number whatever the session's ANSI setting
            val = F.when(raw.isNotNull() & raw.try_cast(typ).isNull(), F.raise_error(
                F.concat(F.lit(f"bad {name} in {kind} line: "), F.col("value")))
            ).otherwise(raw.try_cast(typ))
        else:
            val = raw.try_cast(typ)
        cols.append(val.alias(name))
    out = lines.select(*cols)
    if mode == "drop":
        out = out.dropna(subset=[n for n, _, _ in spec])
    return out


def parse_movie_lines(lines: DataFrame, sep: str = ",", mode: str = "strict") -> DataFrame:
    """``mid,name,genres`` (all trimmed) -> (mid INT, name, genres)."""
    return _parse(lines, "movie", sep, mode)


def parse_rating_lines(lines: DataFrame, sep: str = ",", mode: str = "strict") -> DataFrame:
    """``uid,mid,score,timestamp`` -> Rating; extra fields are ignored."""
    return _parse(lines, "rating", sep, mode)


def parse_tag_lines(lines: DataFrame, sep: str = ",", mode: str = "strict") -> DataFrame:
    """``uid,mid,tag,timestamp`` -> Tag; extra fields are ignored."""
    return _parse(lines, "tag", sep, mode)


def line_counts(lines: DataFrame, kind: str, sep: str = ",") -> DataFrame:
    """(kind, n_lines, n_dropped): one row, how many lines ``mode='drop'``
    leaves out."""
    parsed = _mark_bad(lines, kind, sep)
    return parsed.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("bad").alias("n_dropped")) \
        .select(F.lit(kind).alias("kind"), "n_lines", "n_dropped")


def _mark_bad(lines: DataFrame, kind: str, sep: str) -> DataFrame:
    parts = split_fields(F.col("value"), sep)
    bad = F.lit(False)
    for i, (_, typ, trim) in enumerate(_SPECS[kind]):
        raw = F.get(parts, i)
        raw = java_trim(raw) if trim else raw
        bad = bad | (raw if typ == "string" else raw.try_cast(typ)).isNull()
    return lines.select(bad.alias("bad"))


_PARSERS = {"movie": parse_movie_lines, "rating": parse_rating_lines, "tag": parse_tag_lines}
_SCHEMAS = {"movie": schemas.MOVIE, "rating": schemas.RATING, "tag": schemas.TAG}


def read_lines(spark: SparkSession, path: str, kind: str, sep: str = ",",
               mode: str = "strict") -> DataFrame:
    """Read a delimited file of ``kind`` in {'movie','rating','tag'}."""
    if mode in ("quoted", "quoted_strict"):
        # extra fields are ignored (as the naive split does); a missing or
        # bad field comes back null.  All fields are read as text first, so
        # that a bad number is told from a missing one and trims apply
        schema = _SCHEMAS[kind]
        text = ", ".join(f"`{f.name}` string" for f in schema.fields)
        df = (spark.read.schema(text).option("sep", sep).option("quote", '"')
              .option("mode", "PERMISSIVE").csv(path))
        strict = mode == "quoted_strict"
        cols = []
        for name, typ, trim in _SPECS[kind]:
            raw = java_trim(F.col(name)) if trim else F.col(name)
            val = raw if typ == "string" else raw.try_cast(typ)
            if strict:
                val = F.when(val.isNull(), F.raise_error(
                    F.concat(F.lit(f"bad or missing {name} in {kind} line: "),
                             F.concat_ws(sep, *df.columns)))).otherwise(val)
            cols.append(val.alias(name))
        out = df.select(*cols)
        return out if strict else out.dropna(subset=[f.name for f in schema.fields])
    return _PARSERS[kind](spark.read.text(path), sep=sep, mode=mode)
