"""Maintenance over whole layers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.operators.versioned import VersionedTable
from silverlode.sources.layers import TABLES, Layers

# Tables that are clustered when they are compacted, and by what.
CLUSTERED = {("silver", "transactions"): ["transaction_id"]}

MAIN_LAYERS = ("bronze", "silver", "gold")

_OUTCOME = "layer string, table string, done boolean, version bigint, problem string"


def _each(spark: SparkSession, layers: Layers, tables: dict | None, action) -> DataFrame:
    """Run an action per table.  One table's trouble does not stop the others; it is
    reported in the outcome, not swallowed."""
    tables = tables or {layer: TABLES[layer] for layer in MAIN_LAYERS}
    outcome = []
    for layer, names in tables.items():
        for name in names:
            table = VersionedTable(spark, layers.path(layer, name))
            if not table.exists():
                outcome.append((layer, name, False, None, "no such table"))
                continue
            try:
                outcome.append((layer, name, True, action(layer, name, table), None))
            except Exception as problem:                     # noqa: BLE001
                outcome.append((layer, name, False, None, str(problem)[:500]))
    return spark.createDataFrame(outcome, _OUTCOME)


def compact_tables(
    spark: SparkSession, layers: Layers, tables: dict | None = None, now: dt.datetime | None = None
) -> DataFrame:
    return _each(spark, layers, tables, lambda layer, name, table: table.compact(
        zorder_by=CLUSTERED.get((layer, name)), now=now))


def fold_upserts(spark: SparkSession, layers: Layers, now: dt.datetime | None = None) -> list[str]:
    """Compact the silver tables whose latest commit is an upsert."""
    done = []
    for name in TABLES["silver"]:
        table = VersionedTable(spark, layers.path("silver", name))
        if table.exists() and table.has_pending_upserts():
            table.compact(zorder_by=CLUSTERED.get(("silver", name)), now=now)
            done.append(name)
    return done


def expire_tables(
    spark: SparkSession, layers: Layers, retention_hours: float = 168,
    tables: dict | None = None, now: dt.datetime | None = None,
) -> DataFrame:
    before = (now or dt.datetime.now()) - dt.timedelta(hours=retention_hours)
    return _each(spark, layers, tables, lambda layer, name, table: table.expire(before, now))


def layer_metrics(spark: SparkSession, layers: Layers) -> DataFrame:
    """Rows written and rejected per table and version, from the commit logs."""
    logs = []
    for layer, names in TABLES.items():
        for name in names:
            table = VersionedTable(spark, layers.path(layer, name))
            if table.exists():
                logs.append(table.history().select(
                    F.lit(layer).alias("layer"), F.lit(name).alias("table"),
                    "version", "committed_at", "operation", "row_count",
                    F.get_json_object("metrics", "$.accepted").cast("bigint").alias("accepted"),
                    F.get_json_object("metrics", "$.rejected").cast("bigint").alias("rejected")))
    if not logs:
        raise LookupError(f"no tables under {layers.base}")
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log)
    return out
