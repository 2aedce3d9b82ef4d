"""File layout: packing and clustering."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.operators.skew import spread_lane

_SLOTS = 64
# Quantiles per column are planned as a tree of comparisons: 2**MAX_BITS leaves at most.
MAX_BITS = 9


def pack(df: DataFrame, files: int, partition_by: list[str] | None = None, shuffled: bool = False) -> DataFrame:
    """Bring rows into ``files`` tasks before a write.

    Unpartitioned plain scans are merged without a shuffle.  Partitioned output is
    range-partitioned with its partition columns in the lead, so that a task writes few
    of their values, and by input partition after them, which cuts a value that is
    too large for one task.
    """
    if partition_by:
        return _laned(df, files, [F.col(c) for c in partition_by])
    return df.repartition(files) if shuffled else df.coalesce(files)


def _laned(df: DataFrame, files: int, by: list[Column], sort: list[str] | None = None) -> DataFrame:
    ranged = df.withColumn("_lane", spread_lane()).repartitionByRange(files, *by, F.col("_lane"))
    return (ranged.sortWithinPartitions(*sort) if sort else ranged).drop("_lane")


def _common_start(df: DataFrame, names: list[str]) -> dict[str, int]:
    """Bytes that all values of a text column share at their start: those of its least and
    greatest value.  One aggregate for all columns, two values each to the driver."""
    if not names:
        return {}
    row = df.agg(*[f(F.encode(n, "UTF-8")).alias(f"{f.__name__}_{n}") for n in names for f in (F.min, F.max)]).first()
    return {n: len(os.path.commonprefix([bytes(row[f"min_{n}"] or b""), bytes(row[f"max_{n}"] or b"")])) for n in names}


def _as_number(df: DataFrame, name: str, skip: int = 0) -> Column:
    """An order-keeping number.  Text maps to six bytes after the ``skip`` it has in common."""
    kind = dict(df.dtypes)[name]
    value = F.col(name)
    if kind == "string":
        head = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), skip + 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if kind == "boolean":
        return value.cast("int").cast("double")
    return value.cast("double")


def quantile_cuts(df: DataFrame, columns: list[str], bits: int, skip: dict[str, int] | None = None) -> list[list[float]]:
    """``2**bits - 1`` approximate quantiles per column.

    Sketched per slot of input partitions first, then over the slots' quantiles, so
    no task merges more than a slot's sketches.  What reaches the driver has a
    fixed size.  Cuts steer the file layout only, never which rows are written.
    """
    steps = 2 ** bits
    fractions = F.array(*[F.lit(i / steps) for i in range(1, steps)])
    gap = F.array_repeat(F.lit(None).cast("double"), steps - 1)
    names = [f"_n{i}" for i in range(len(columns))]
    per_slot = (
        df.select((spread_lane() % _SLOTS).alias("slot"),
                  *[_as_number(df, c, (skip or {}).get(c, 0)).alias(n) for c, n in zip(columns, names)])
        .groupBy("slot")
        .agg(*[F.coalesce(F.percentile_approx(n, fractions, 10 * steps), gap).alias(n) for n in names])
    )
    row = (
        per_slot.select(F.inline(F.arrays_zip(*names)))
        .agg(*[F.percentile_approx(n, fractions, 10 * steps).alias(n) for n in names])
        .first()
    )
    return [sorted(set(row[n] or [])) for n in names]


def bucket_of(number: Column, cuts: list[float]) -> Column:
    """How many cuts lie below the number (NULL: 0), as a balanced tree of
    comparisons that stays inside generated code."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(number > cuts[middle], search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(cuts)).cast("bigint")


def interleave(buckets: list[Column], bits: int) -> Column:
    """Z-value: bit j of bucket i goes to position j * n + i."""
    n = len(buckets)
    pieces = [
        F.shiftleft(F.shiftright(b, j).bitwiseAND(F.lit(1)), j * n + i)
        for i, b in enumerate(buckets) for j in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), pieces)


def zorder(df: DataFrame, columns: list[str], partitions: int, partition_by: list[str] | None = None) -> DataFrame:
    """Cluster rows so that Parquet min/max ranges are narrow in every one of ``columns``.

    One column is simply ranged and sorted, whatever its type.  Several share a z-curve
    with as many steps as the files can tell apart, and rows inside a file are sorted
    along it, so row groups skip as well.  Partition columns lead.  The input
    partition comes last: a value that holds a large part of the table is cut over
    several tasks instead of landing in one.
    """
    lead = list(partition_by or [])
    if len(columns) == 1:
        return _laned(df, partitions, [F.col(c) for c in [*lead, *columns]], [*lead, *columns])
    # a few steps more than files, shared among the columns
    bits = max(2, min(62 // len(columns), -(-(max(partitions, 1) * 16).bit_length() // len(columns)), MAX_BITS))
    names = [f"_b{i}" for i in range(len(columns))]
    skip = _common_start(df, [c for c in columns if dict(df.dtypes)[c] == "string"])
    cuts = quantile_cuts(df, columns, bits, skip)
    keyed = df.withColumns({
        n: bucket_of(_as_number(df, c, skip.get(c, 0)), cut) for n, c, cut in zip(names, columns, cuts)
    }).withColumns({"_z": interleave([F.col(n) for n in names], bits)})
    ranged = _laned(keyed, partitions, [*[F.col(c) for c in lead], F.col("_z")], [*lead, "_z", *columns])
    return ranged.select(*df.columns)
