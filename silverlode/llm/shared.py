"""Tables, sizes and clash-free columns for the operators of this subpackage."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.session import remove_path, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (long) and text alone: other columns never reach a shuffle or Python."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts: one narrow aggregate, from which partition counts follow."""
    return int(docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0)


def written(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """df written to the shared folder and read back: lineage ends there, and lost
    executors cost no more than the tasks that were running."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        remove_path(spark, path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of frames that are no longer referenced.  Its cleaner
    works beside the driver, once references are gone on both sides."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)
