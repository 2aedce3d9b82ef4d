"""From the bus envelope to transaction rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode import schemas
from silverlode.plans.bronze import with_event_time, with_lineage

# Lineage labels of rows that came in through the bus.
STREAM_FILE, STREAM_SOURCE = "kafka_stream", "kafka"


# Text of a message that is no JSON object.
MALFORMED = "_malformed_value"


def decode_events(
    envelope: DataFrame, schema: T.StructType = schemas.TRANSACTIONS, keep_malformed: bool = False,
) -> DataFrame:
    """Parse the JSON value.  Malformed JSON gives a row of NULLs, which the quality
    rules reject later; with ``keep_malformed`` its text comes along."""
    text = F.col("value").cast("string")
    kept = [F.when(~_is_object(text), F.coalesce(text, F.lit(""))).alias(MALFORMED)] if keep_malformed else []
    return envelope.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.from_json(text, schema).alias("data"), *kept,
    ).select("kafka_key", "kafka_timestamp", "data.*", *([MALFORMED] if keep_malformed else []))


def _is_object(text: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def split_malformed(envelope: DataFrame, schema: T.StructType = schemas.TRANSACTIONS) -> tuple[DataFrame, DataFrame]:
    """(envelopes whose value is a JSON object, the others with their text)."""
    text = F.col("value").cast("string")
    return envelope.where(_is_object(text)), envelope.where(~_is_object(text)).withColumn("value_text", text)


def enrich_events(decoded: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    return with_event_time(with_lineage(decoded, F.lit(STREAM_FILE), STREAM_SOURCE, now))
