"""Streaming jobs.  Each owns its checkpoint: two queries never share one."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from silverlode.operators.partitioned import PartitionedTable
from silverlode.operators.versioned import VersionedTable
from silverlode.plans.daily import advance
from silverlode.plans.silver import process_entity
from silverlode.sources.layers import Layers
from silverlode.streaming.events import MALFORMED, decode_events, enrich_events
from silverlode.streaming.windows import LATENESS, WINDOW, window_totals

# Production trigger intervals.
INGEST_EVERY, TOTALS_EVERY = "10 seconds", "30 seconds"


def _start(
    df: DataFrame, sink: Callable[[DataFrame, int], None], mode: str, checkpoint: str,
    every: str | None, name: str | None,
) -> StreamingQuery:
    """``every=None`` takes what is there and stops."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def _identity(batch: DataFrame, writer: str) -> str:
    """Who writes: the job's name and the query id kept in its checkpoint.  Batch
    numbers only mean something within one checkpoint; a query that starts over
    with a new one counts as somebody else, and its batches are not skipped."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{writer}:{query_id}"


def ingest_stream(
    envelope: DataFrame, table_path: str, checkpoint: str, lateness: str = LATENESS,
    every: str | None = INGEST_EVERY, writer: str = "stream-ingest", name: str | None = None,
    now: dt.datetime | None = None, malformed_path: str | None = None, metrics_path: str | None = None,
) -> StreamingQuery:
    """Append events to the bronze transactions table.

    Exactly once: the checkpoint remembers offsets, and a batch that is replayed
    after a failure finds its number in the table's log and is skipped.  There is
    no stateful step, so the watermark drops nothing: late rows are kept.

    With ``malformed_path`` a message whose value is no JSON object goes there with its
    text, before the good rows of the batch; otherwise it becomes a row of NULLs that the
    quality rules reject.

    With ``metrics_path`` every batch leaves one row there (see ``batch_metrics``), also just once.
    """
    decoded = decode_events(envelope, keep_malformed=malformed_path is not None)
    rows = enrich_events(decoded, now).withWatermark("transaction_timestamp", lateness)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, guard = batch.sparkSession, {"writer": _identity(batch, writer), "batch": batch_id}
        if malformed_path is not None:
            torn = batch.where(F.col(MALFORMED).isNotNull()).select(
                "kafka_key", "kafka_timestamp", F.col(MALFORMED).alias("value_text"), "ingestion_timestamp")
            VersionedTable(spark, malformed_path).append(torn, operation="STREAM", **guard)
            batch = batch.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
        if metrics_path is not None:
            VersionedTable(spark, metrics_path).append(batch_metrics(batch, batch_id), operation="STREAM", **guard)
        VersionedTable(spark, table_path).append(batch, operation="STREAM", **guard)

    return _start(rows, sink, "append", checkpoint, every, name)


def batch_metrics(batch: DataFrame, batch_id: int) -> DataFrame:
    """One row: how many events a batch brought, how many of them without id or time, and the
    span of event times.  An aggregate of two columns, combined map-side; the batch's other columns are not read."""
    return batch.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("transaction_id").isNull() | F.col("transaction_timestamp").isNull()).alias("n_incomplete"),
        F.min("transaction_timestamp").alias("first_time"), F.max("transaction_timestamp").alias("last_time"),
    ).select(F.lit(batch_id).cast("long").alias("batch_id"), "*")


def totals_table(spark: SparkSession, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, F.to_date("window_start"), ["window_start", "status_key"])


def windowed_stream(
    envelope: DataFrame, table_path: str, checkpoint: str, window: str = WINDOW,
    lateness: str = LATENESS, every: str | None = TOTALS_EVERY, mode: str = "update", name: str | None = None,
) -> StreamingQuery:
    """Keep window totals up to date, keyed by (window, status) and partitioned by the window's day.

    ``update`` writes the changed windows of every batch, ``append`` only windows
    that are final.  A batch replaces the days its windows are in and nothing else, so the table holds
    each total once, however long the stream runs; totals are whole values, so the same batch
    again, after a failure, changes nothing.
    """
    totals = window_totals(enrich_events(decode_events(envelope)), window, lateness)

    def sink(batch: DataFrame, batch_id: int) -> None:
        flat = batch.select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            # a key must not be NULL, and no status must not look like an empty one
            F.coalesce(F.concat(F.lit("="), "status"), F.lit("")).alias("status_key"), "status",
            "transaction_count", "total_revenue")
        totals_table(batch.sparkSession, table_path).merge(flat)

    return _start(totals, sink, mode, checkpoint, every, name)


def silver_stream(
    spark: SparkSession, ticks: DataFrame, layers: Layers, checkpoint: str,
    every: str | None = INGEST_EVERY, name: str | None = None,
) -> StreamingQuery:
    """Run the incremental bronze-to-silver job whenever ``ticks`` brings rows.
    The job keeps its own mark, so a repeated batch finds nothing to do."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        process_entity(batch.sparkSession, layers, "transactions")

    return _start(ticks, sink, "append", checkpoint, every, name)


def gold_stream(
    spark: SparkSession, ticks: DataFrame, layers: Layers, checkpoint: str,
    every: str | None = TOTALS_EVERY, name: str | None = None, as_of: dt.date | None = None,
) -> StreamingQuery:
    """Bring silver and then gold up to date whenever ``ticks`` brings rows, by the days that the new
    rows touch.  The job keeps its own marks, so a repeated batch finds nothing to do."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        advance(batch.sparkSession, layers, as_of=as_of)

    return _start(ticks, sink, "append", checkpoint, every, name)
