"""Event stream sources.  Both give the envelope ``key, value, timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverlode import schemas


def bus_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_loss: bool = False,
    **options: str,
) -> DataFrame:
    """A Kafka topic.  Needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_loss).lower())
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema=None,
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files dropped into a directory, taken oldest first."""
    reader = spark.readStream.format(fmt).schema(schema or schemas.ENVELOPE)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
