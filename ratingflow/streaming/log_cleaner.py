"""Log cleaning stream: raw log lines -> rating messages.

Stateless: keep lines holding the rating prefix, take the text between the
first and second prefix, trim it, drop empty payloads, and forward it with
the constant key.  Source and sink formats are injected (Kafka topics in
production, files in tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratingflow.functions.scalar import log_payload
from ratingflow.params import LOG_KEY, RATING_PREFIX


def clean_log(df: DataFrame, value_col: str = "value", prefix: str = RATING_PREFIX,
              key: str = LOG_KEY, binary: bool = False) -> DataFrame:
    """(other columns..., key, value): cleaned messages.  ``value`` may be
    STRING or BINARY (Kafka); ``binary`` gives key and value back as bytes."""
    payload = log_payload(F.col(value_col).cast("string"), prefix)
    keep = [c for c in df.columns if c not in (value_col, "key")]
    out = df.select(*keep, F.lit(key).alias("key"), payload.alias("value"))
    out = out.where(F.col("value").isNotNull() & (F.col("value") != ""))
    if binary:
        out = out.withColumns({c: F.col(c).cast("binary") for c in ("key", "value")})
    return out


def start_log_cleaner(spark: SparkSession, source_format: str, source_options: dict,
                      sink_format: str, sink_options: dict, checkpoint: str,
                      schema: str | None = None, available_now: bool = False,
                      trigger_seconds: int = 2, source_path: str | None = None,
                      sink_path: str | None = None) -> StreamingQuery:
    """Start the cleaner.  E.g. Kafka: source_format='kafka',
    source_options={'kafka.bootstrap.servers': .., 'subscribe': 'abc'},
    sink_format='kafka', sink_options={'topic': 'recommender', ...}."""
    reader = spark.readStream.format(source_format).options(**source_options)
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.load(source_path) if source_path else reader.load()
    out = clean_log(raw, binary=sink_format == "kafka")
    if sink_format == "kafka":
        out = out.select("key", "value")
    writer = (out.writeStream.format(sink_format).options(**sink_options)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start(sink_path) if sink_path else writer.start()
