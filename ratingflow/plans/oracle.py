"""DuckDB oracle SQL for the named queries.

Each statement re-derives the contract tables from the driver tables with
DuckDB's own functions (see ``sources/fixtures.py`` for the Spark side) and
computes the same result independently of Spark.
"""

from __future__ import annotations

# Contract tables in DuckDB (mirrors sources/fixtures.py).
RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS uid, CAST(l_partkey AS INTEGER) AS mid,
         ceil(l_quantity / 5) / 2 AS score,
         CAST(floor(epoch(l_shipdate)) AS INTEGER) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MOVIES = """movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name,
         concat_ws('|', p_type, replace(p_name, ' ', '|')) AS genres
  FROM part)"""

TAGS = """tags AS (
  SELECT CAST(user_id AS INTEGER) AS uid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
         event_type AS tag, CAST(floor(epoch(ts)) AS INTEGER) AS "timestamp"
  FROM events)"""

LOGLINES = """loglines AS (
  SELECT event_id,
         CASE WHEN event_type = 'purchase' THEN concat(
              'INFO MOVIE_RATING_PREFIX: ', CAST(user_id AS VARCHAR), '|',
              json_extract_string(props, '$.k'), '|',
              CAST(least(5.0, greatest(0.5, ceil(value / 20) / 2)) AS VARCHAR), '|',
              CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR), ' ')
         ELSE concat('INFO ', event_type) END AS line
  FROM events)"""

PAYLOADS = LOGLINES + """,
payloads AS (
  SELECT event_id, trim(split_part(line, 'MOVIE_RATING_PREFIX:', 2)) AS payload
  FROM loglines
  WHERE contains(line, 'MOVIE_RATING_PREFIX:')
    AND trim(split_part(line, 'MOVIE_RATING_PREFIX:', 2)) <> '')"""

MESSAGES = PAYLOADS + """,
messages AS (
  SELECT event_id,
         CAST(split_part(payload, '|', 1) AS INTEGER) AS uid,
         CAST(split_part(payload, '|', 2) AS INTEGER) AS mid,
         CAST(split_part(payload, '|', 3) AS DOUBLE) AS score,
         CAST(split_part(payload, '|', 4) AS INTEGER) AS "timestamp"
  FROM payloads)"""

VECTORS = """vectors AS (
  SELECT CAST(vec_id AS INTEGER) AS mid, CAST(embedding AS DOUBLE[]) AS features
  FROM embeddings)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
