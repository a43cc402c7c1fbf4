"""The registered queries of this package: each operator over its whole table.

``QUERIES`` maps a name to ``fn(spark, sf_dir)``, ``ORACLE`` a name to DuckDB
SQL where SQL can express the query.  The queries derive their digest columns
from what the operators return.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingflow.llm import (decontaminate, importance, langid, packing, phrases, quality, simhash, substring_dedup,
                            suffix_dedup, toxicity, urls, vector_codes, warc)
from ratingflow.llm.common import saved, table, vocabulary
from ratingflow.session import remove_scratch, scratch_path


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 4-word shingles, 4 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: Rules of the URL query: hosts with a path, and the verdict.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents: one row for each occurrence."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of 200-byte strings that occur elsewhere, over all documents."""
    done = suffix_dedup.dedup(table(spark, sf_dir, "documents"), length=200)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of 20-word windows that occur earlier, over all documents."""
    done = substring_dedup.dedup(table(spark, sf_dir, "documents"), length=20)
    return done.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    return langid.identify(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return phrases.edited_fingerprints(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), size=2048)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, and the archives read back."""
    path = scratch_path(spark, "archives")
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.records(warc.read(spark, path, payloads=False))
    out = saved(found.select(warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                             "record_type", warc.page_of(F.col("refers_to")).alias("refers_to")), "archived-pages")
    remove_scratch(spark, path)
    return out


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors: 16 parts, 64 entries, two rounds."""
    done = vector_codes.encode(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    return done.drop("label", "computed")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all documents drawn towards the benchmark's distribution."""
    done = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25)
    return done.drop("n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_urls": op2_urls,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_decontaminate": op5_decontaminate,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_langid": op8_langid,
    "op9_fingerprints": op9_fingerprints,
    "op10_packing": op10_packing,
    "op11_warc": op11_warc,
    "op12_vector_codes": op12_vector_codes,
    "op13_importance": op13_importance,
}

ORACLE: dict[str, str] = {
    "op7_substring_dedup": r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
wins AS (
  SELECT doc_id, pos0, array_to_string(list_slice(words, pos0, pos0 + 19), ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos0 FROM docs WHERE len(words) >= 20)),
later AS (
  SELECT doc_id, pos0 FROM (
    SELECT doc_id, pos0, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos0) AS n FROM wins)
  WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos0, pos0 + 20)) AS pos FROM later),
marks AS (SELECT doc_id, list(pos) AS pos FROM gone GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, d.words, m.pos AS gone,
    CASE WHEN m.pos IS NULL THEN d.words
         ELSE list_select(d.words, list_filter(range(1, len(d.words) + 1), lambda p: NOT list_contains(m.pos, p))) END AS left_
  FROM docs d LEFT JOIN marks m USING (doc_id))
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(left_, ' ')) AS kept_sha256
FROM kept""",
    "op11_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
sums AS (
  SELECT page_id, strlen(html)::BIGINT AS n, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS lead FROM p)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = lead THEN NULL ELSE lead END AS refers_to
FROM sums""",
}


def _vector_codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """The plain form: all distances of parts and entries, round by round."""
    steps = [f"""
kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (
  SELECT vec_id, label, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS x
  FROM kept, range({parts}) AS parts(p)),
ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {entries}),
book0 AS (SELECT p, e, x AS c FROM cut JOIN ids USING (vec_id))"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS (
  SELECT vec_id, label, p, x, least.d AS d, least.e AS e FROM (
    SELECT vec_id, label, p, any_value(x) AS x,
      min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e}}) AS least
    FROM cut JOIN book{r} USING (p) GROUP BY vec_id, label, p))""")
        if r < rounds:
            steps.append(f"""
mean{r + 1} AS (
  SELECT p, e, list(floor(total / n)::BIGINT ORDER BY i) AS c FROM (
    SELECT p, e, i, sum(y)::DOUBLE AS total, count(*) AS n
    FROM (SELECT p, e, unnest(x) AS y, unnest(range(len(x))) AS i FROM near{r}) GROUP BY p, e, i)
  GROUP BY p, e),
book{r + 1} AS (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r + 1} m USING (p, e))""")
    return f"""
WITH {",".join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM near{rounds} GROUP BY vec_id, label),
sha AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, sha"""


ORACLE["op12_vector_codes"] = _vector_codes_sql(parts=16, entries=64, rounds=2, scale=256)
