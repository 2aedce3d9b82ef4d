"""Keeping the newest row of every key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.operators.skew import spread_lane

# Fixed value: column that says how recent a row is.
RECENCY = "ingestion_timestamp"

RANK = "_rank"

# Fixed value: a key of up to so many rows is ranked in one task.
HOT_ROWS = 100_000

# Bits in which repeated keys are noted, and how many of them one bitmap has.
NOTED_BITS, MAP_BITS = 1 << 27, 1 << 15


def recency_order(df: DataFrame, keys: list[str], newest_by: str, ties: list[str] | None) -> list[Column]:
    """Newest first (NULL last), then a total order over the other columns, so the
    survivor does not depend on how rows are spread over tasks."""
    if ties is None:
        ties = [c for c, t in df.dtypes if c not in keys and c != newest_by and not t.startswith("map")]
    return [F.col(newest_by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties]]


def rank_within_key(
    df: DataFrame,
    keys: list[str],
    newest_by: str = RECENCY,
    ties: list[str] | None = None,
    alive: Column | None = None,
) -> DataFrame:
    """Add ``_rank``: 1 for the surviving row of each key, more for the others.

    Rows for which ``alive`` is false take no part; they only travel along, spread
    over all tasks whatever their key is.  Keys are compared the way a window does
    (NULL is one key).

    How often a key comes is a map-side aggregate over the keys alone.  Keys of more than ``HOT_ROWS`` rows,
    at most one in so many rows of the frame, are broadcast; their rows are ranked in lanes.  Other live rows
    whose key may come again (``_may_repeat``) are shuffled once, by their key, and ranked there.  A row that
    is alone with its key is first and stays where it is.
    """
    live = F.lit(True) if alive is None else F.coalesce(alive, F.lit(False))
    names = [f"_k{i}" for i in range(len(keys))]
    counted = df.where(live).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(counted.where(F.col("_n") > HOT_ROWS).select(*names))
    same_key = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    window = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*recency_order(df, keys, newest_by, ties))
    noted = _note_repeated(counted, names)
    rivals = _may_repeat(df.where(live), keys, noted).where("_again").drop("_again")
    ranked = rivals.join(hot, same_key, "left_anti").withColumn(RANK, F.row_number().over(window))
    ranked = ranked.unionByName(_rank_in_lanes(df.where(live).join(hot, same_key, "left_semi"), keys, newest_by, ties))
    aside = _may_repeat(df, keys, noted).where(~live | ~F.col("_again")).drop("_again")
    return ranked.unionByName(aside.withColumn(RANK, F.when(live, F.lit(1)).otherwise(F.lit(2))))


def _place(keys: list[str]) -> tuple[Column, Column]:
    """Number of a key's bitmap, and its bit there."""
    slot = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(NOTED_BITS))
    return F.floor(slot / MAP_BITS).cast("int"), slot % MAP_BITS


def _note_repeated(counted: DataFrame, names: list[str]) -> DataFrame:
    """Bitmaps in which every key of several rows has its bit set: 16 MB at most, however many keys there are."""
    number, bit = _place(names)
    return F.broadcast(
        counted.where(F.col("_n") > 1).groupBy(number.alias("_map")).agg(F.bitmap_construct_agg(bit).alias("_bits")))


def _may_repeat(df: DataFrame, keys: list[str], noted: DataFrame) -> DataFrame:
    """Add ``_again``: true for all rows of a repeated key, and for rows of other keys that share its bit."""
    number, bit = _place(keys)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, (bit % 8).cast("int")), F.lit(0)) == 1
    return df.join(noted, number.eqNullSafe(F.col("_map")), "left").withColumn("_again", found).drop("_map", "_bits")


def _rank_in_lanes(df: DataFrame, keys: list[str], newest_by: str, ties: list[str] | None) -> DataFrame:
    """Every key is ranked twice: inside each input partition first, then the partition
    winners against each other.  No task holds more of a key than one input
    partition does, or one row of each partition, however large the key is.  Both rankings run over one
    plan: a branch of their own for the winners would evaluate the lanes twice, and
    adaptive execution may number the partitions of two branches differently.
    """
    order = recency_order(df, keys, newest_by, ties)

    def ranked(rows: DataFrame, lane: str, out: str) -> DataFrame:
        window = Window.partitionBy(*[F.col(k) for k in keys], F.col(lane)).orderBy(*order)
        return rows.withColumn(out, F.row_number().over(window))

    first = ranked(df.withColumn("_lane", spread_lane()), "_lane", "_local")
    return (
        ranked(first.withColumn("_final", F.when(F.col("_local") == 1, F.lit(None).cast("int")).otherwise(F.col("_lane"))), "_final", "_among")
        .withColumn(RANK, F.when(F.col("_local") == 1, F.col("_among")).otherwise(F.lit(2)))
        .drop("_lane", "_local", "_final", "_among")
    )


def split_duplicates(
    df: DataFrame, keys: list[str], newest_by: str = RECENCY, ties: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(newest row per key, the rows it displaced)."""
    ranked = rank_within_key(df, keys, newest_by, ties)
    return ranked.where(F.col(RANK) == 1).drop(RANK), ranked.where(F.col(RANK) > 1).drop(RANK)


def newest_per_key(
    df: DataFrame, keys: list[str], newest_by: str = RECENCY, ties: list[str] | None = None
) -> DataFrame:
    """Only the survivors.  A filter ``row_number = 1`` lets Spark keep one row per
    key in every map task before the shuffle, so no hot-key search is needed."""
    window = Window.partitionBy(*keys).orderBy(*recency_order(df, keys, newest_by, ties))
    return df.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) == 1).drop(RANK)
