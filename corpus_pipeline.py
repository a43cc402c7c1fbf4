"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``
in the columns of ``documents``; the last returns the packed pieces.  ``run``
writes each stage's result to the shared checkpoint folder and reads it again
for the next, so that a lost executor repeats one stage at most.

All stages take null and repeated ids, null and empty texts, columns beside
those of ``documents`` (kept as they are, whatever their names) and an empty
table (nothing stays).  Rows that share an id, or have none, are documents of
their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratingflow.llm import decontaminate, packing, quality, simhash, substring_dedup
from ratingflow.llm.common import discard, saved, table, vocabulary


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.5 or more).  Null
    and empty texts score like any line of no words."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model, threshold=0.5)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id (null the largest, of equal
    ids that with the smallest text), of each SimHash group.  Texts without a
    word are copies of each other."""
    return simhash.representatives(docs, words=4, bits=4)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 20-word windows that occur earlier (by id, null the
    smallest, then text).  A document that loses all its words goes; one that
    has none, or a null text, stays."""
    return substring_dedup.rewrite(docs, length=20)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage; null and empty texts hold
    none, null and empty items match nothing."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of at most 2048 tokens; a
    null or empty text is one piece, its end alone."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), size=2048)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL can express neither the classifier nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = raw = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not raw:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
