"""Places and running sums of rows in an order, without a task that holds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverlode.llm.shared import written

#: Rows of one key that a task sums one by one; beyond that it sums sums.
SPAN = 1024


def _before(total: str, window) -> Column:
    return F.coalesce(F.sum(total).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))


def _beside(keys: list[str], left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
    """Equi-join on ``keys``, where null equals null, and on ``more``."""
    right = right.select(*(F.col(k).alias(f"_{k}") for k in [*keys, *more]), *(c for c in right.columns if c not in [*keys, *more]))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col(k) == F.col(f"_{k}") for k in more]
    return left.join(right, same).drop(*(f"_{k}" for k in [*keys, *more]))


def placed(df: DataFrame, keys: list[str], order: list[str], copies: str, purpose: str) -> tuple[DataFrame, str]:
    """``df`` with ``pos``: the sum of ``copies`` over the rows of the same keys that come before it
    (by keys, then ``order``; nulls first, text by code point), and the path of the table behind it.

    Ranges of the whole order become partitions of a written table; a row's place is its place in
    its range and the sizes of the ranges before it.  A task holds one range, or one number per range.
    """
    by = [*keys, *order]
    ranged = df.repartitionByRange(*(F.col(c).asc_nulls_first() for c in by)).withColumn("_range", F.spark_partition_id())
    stored, path = written(ranged, purpose)
    own = Window.partitionBy(*keys, "_range").orderBy(*(F.col(c).asc_nulls_first() for c in order or keys))
    sums = stored.groupBy(*keys, "_range").agg(F.sum(copies).alias("_n"))
    sums = sums.select(*keys, "_range", _before("_n", Window.partitionBy(*keys).orderBy("_range")).alias("_first"))
    inside = stored.withColumn("_place", _before(copies, own))
    return _beside(keys, inside, sums, "_range").withColumn("pos", F.col("_first") + F.col("_place")).drop("_range", "_first", "_place"), path


def running(df: DataFrame, key: str, place: str, value: str, span: int = SPAN) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over the rows of its key with a smaller ``place``.

    Places are cut into spans; a row's sum is that of the spans before and of its own span's rows."""
    df = df.withColumn("_span", F.expr(f"{place} div {span}"))
    sums = df.groupBy(key, "_span").agg(F.sum(value).alias("_n"))
    sums = sums.select(key, "_span", _before("_n", Window.partitionBy(key).orderBy("_span")).alias("_first"))
    inside = df.withColumn("_place", _before(value, Window.partitionBy(key, "_span").orderBy(place)))
    return inside.join(sums, [key, "_span"]).withColumn("before", F.col("_first") + F.col("_place")).drop("_span", "_first", "_place")
