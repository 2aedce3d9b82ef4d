"""Raw files into bronze: every row as it came, plus where it came from."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions.time import clock, parse_event_time
from silverlode.operators.versioned import VersionedTable
from silverlode.sources.files import read_raw
from silverlode.sources.layers import Layers

# Fixed value: label of rows that came in through files.
FILE_SOURCE = "ecommerce"


def with_lineage(
    df: DataFrame, source_file: Column, data_source: str, now: dt.datetime | None = None
) -> DataFrame:
    return df.withColumns({
        "ingestion_timestamp": clock(now),
        "source_file": source_file,
        "data_source": F.lit(data_source),
        "ingestion_date": clock(now).cast("date"),
    })


def with_event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_timestamp", parse_event_time("transaction_date"))


def enrich_files(df: DataFrame, entity: str, now: dt.datetime | None = None) -> DataFrame:
    """Lineage columns for rows read from files; transactions also get their event
    time as a timestamp."""
    out = with_lineage(df, F.col("_metadata.file_path"), FILE_SOURCE, now)
    return with_event_time(out) if entity == "transactions" else out


def ingest(
    spark: SparkSession,
    source: str,
    layers: Layers,
    entity: str,
    fmt: str = "csv",
    infer: bool = False,
    register_as: str | None = None,
    partition_by_day: bool = True,
    now: dt.datetime | None = None,
    keep_corrupt: bool = False,
) -> int:
    """Append one raw batch to its bronze table and return the version written.

    The files are scanned once.  ``register_as`` names a catalog table that holds
    the latest batch only.  ``keep_corrupt`` keeps the text of rows that do not fit the declared
    columns; silver's rules then send these rows to quarantine with it.
    """
    batch = enrich_files(read_raw(spark, source, entity, fmt, infer=infer, keep_corrupt=keep_corrupt), entity, now)
    table = VersionedTable(spark, layers.path("bronze", entity))
    version = table.append(
        batch,
        operation="INGEST",
        partition_by=["ingestion_date"] if partition_by_day else [],
        now=now,
    )
    if register_as:
        register_latest(table, version, register_as)
    return version


def register_latest(table: VersionedTable, version: int, name: str, path: str | None = None) -> None:
    """(Re-)make a catalog table of the rows of one commit.  It has files of its own (at ``path``, or the
    warehouse), so neither compaction nor expiry of the versions takes them away."""
    parts = table.commit_of(version).partition_by
    table.spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = table.read_since(version - 1, version).write.mode("overwrite").format("parquet")
    if parts:
        writer = writer.partitionBy(*parts)
    (writer.option("path", path) if path else writer).saveAsTable(name)
