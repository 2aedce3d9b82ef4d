"""Keyed tables that change partition by partition.

Plain Parquet, laid out by one value of each row (its day, say).  A merge finds the partitions a
batch touches, works out their new rows and replaces these partitions with Spark's dynamic
partition overwrite: the cost follows the batch and its partitions, never the table.

``rows`` under the table's path holds the rows; while partitions are being replaced, their new rows are
in ``next`` as well.  If a job dies in between, the next reader or writer finishes the
replacement from there, so no row is lost and none comes twice.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverlode.session import CODEC, Stage, list_names, path_exists, publish_names, remove_path

PART = "_part"


def _label(value: Column) -> Column:
    """Directory names start with a letter, so that no reader takes them for numbers or dates."""
    return F.concat(F.lit("p"), F.coalesce(value.cast("string"), F.lit("")))


def _gathered(labelled: DataFrame) -> DataFrame:
    return labelled.hint("rebalance", F.col(PART))


class PartitionedTable:
    """``by`` is an expression over a row's columns; ``keys`` identify a row (NULL equals nothing)."""

    def __init__(self, spark: SparkSession, path: str, by: Column | None = None, keys: list[str] | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.by, self.keys = by, list(keys or [])

    @property
    def _rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def _next(self) -> str:
        return f"{self.path}/next"

    def exists(self) -> bool:
        return bool(self.parts()) or path_exists(self.spark, f"{self._next}/ready")

    def parts(self) -> list[str]:
        """The partitions that hold rows, from directory names alone."""
        return sorted(n.removeprefix(f"{PART}=") for n in list_names(self.spark, self._rows) if n.startswith(f"{PART}="))

    def part_of(self, *values) -> list[str]:
        """Partition names of values of ``by``."""
        return [f"p{'' if v is None else v}" for v in values]

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """All rows, or those of some partitions: the others' directories are not opened."""
        return self._labelled(parts).drop(PART)

    def _labelled(self, parts: list[str] | None = None) -> DataFrame:
        self.recover()
        df = self.spark.read.option("mergeSchema", True).parquet(self._rows)
        return df if parts is None else df.where(F.col(PART).isin(list(parts)))

    # -- writing --------------------------------------------------------------

    def replace(self, df: DataFrame, among: list[str] | None = None) -> list[str]:
        """The partitions that ``df`` has rows for now hold these rows and no others; those of
        ``among`` that it has none for are emptied.  Returns the partitions filled."""
        self.recover()
        seen = Observation()
        self._overwrite(_gathered(df.withColumn(PART, _label(self.by)).observe(seen, F.collect_set(PART).alias("parts"))))
        filled = sorted(seen.get["parts"])       # directory names
        for part in set(among or []) - set(filled):
            remove_path(self.spark, f"{self._rows}/{PART}={part}")
        return filled

    def _overwrite(self, labelled: DataFrame) -> None:
        labelled.write.mode("overwrite").option("compression", CODEC).option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self._rows)

    def merge(self, batch: DataFrame, announce: Callable[[list[str]], None] | None = None, stored: bool = False) -> list[str]:
        """Insert the batch's rows, replacing rows with the same key wherever they are; returns
        the partitions written.  The batch holds a key once at most.

        A row whose key lies in another partition moves: that partition counts as touched.  It is
        found by a semi join over the table's key columns alone.  The same batch again changes nothing.
        ``announce`` is told the partitions before any of them changes.  The batch is read several times: it is
        written to the shared area first, unless it is ``stored`` (read from files, with nothing but narrow steps since).
        """
        announce = announce or (lambda parts: None)
        self.recover()
        labelled = batch.withColumn(PART, _label(self.by))
        with nullcontext() if stored else Stage(labelled, "merge") as stage:
            new = stage.read() if stage else labelled
            if not self.parts():
                announce(sorted(r[0] for r in new.select(PART).distinct().collect()))
                self._overwrite(_gathered(new))             # overwriting: what an attempt that died left here goes
                return self.parts()
            keys = new.select(*self.keys).dropna()
            held = self._labelled()
            moved = held.select(*self.keys, PART).join(keys, self.keys, "left_semi").select(PART)
            touched = sorted(r[0] for r in moved.union(new.select(PART)).distinct().collect())      # directory names
            announce(touched)
            if not touched:
                return []
            rest = held.where(F.col(PART).isin(touched)).join(keys, self.keys, "left_anti")
            merged = new.unionByName(rest, allowMissingColumns=True)
            remove_path(self.spark, self._next)
            self._write(merged, f"{self._next}/rows")
            # the names of the touched partitions come last: with them the replacement is certain
            publish_names(self.spark, f"{self._next}/ready", touched)
        self.recover()
        return touched

    def _write(self, labelled: DataFrame, path: str) -> None:
        _gathered(labelled).write.option("compression", CODEC).partitionBy(PART).parquet(path)

    def recover(self) -> bool:
        """Finish a replacement that is ready; returns whether there was one."""
        touched = set(list_names(self.spark, f"{self._next}/ready"))
        if not touched:
            return False
        filled = {n.removeprefix(f"{PART}=") for n in list_names(self.spark, f"{self._next}/rows") if n.startswith(f"{PART}=")}
        if filled:
            self._overwrite(self.spark.read.option("mergeSchema", True).parquet(f"{self._next}/rows"))      # files of one partition each: no shuffle
        for part in touched - filled:            # all their rows have moved
            remove_path(self.spark, f"{self._rows}/{PART}={part}")
        remove_path(self.spark, self._next)
        return True
