"""Small documents tables with the awkward cases, and plain references."""

from __future__ import annotations

import re

SF = "/root/testdata/sf0.01"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key long, span long, fp long, a long, "
          "b long, length int, score double, label int, target int, sequence_id string, runs string, spans string, "
          "root long, node long, word string, n long, n_bytes int")


def frame(spark, rows):
    """documents with (doc_id, text[, lang]) rows and columns that clash with
    the operators' own names, some of them null."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1]),
             1, 2, 3, 4, 5, 6, 0.5, 1, 7, "x", None, "y", 8, 9, "w", 10, None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame([(*r, "clash", 0) for r in rows],
                                 "doc_id long, quality int, toxic int, label string, most int")


def texts(spark, limit=None):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)[:limit]


def words(text):
    return WORD.findall((text or "").encode())
