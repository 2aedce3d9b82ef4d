"""The whole batch: raw files to gold, in one session."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from silverlode.plans.bronze import ingest
from silverlode.plans.gold import build_gold
from silverlode.plans.silver import SilverResult, build_silver
from silverlode.plans.upkeep import fold_upserts
from silverlode.sources.layers import Layers


def run_batch(
    spark: SparkSession,
    inputs: dict[str, str],
    base: str,
    incremental: bool = True,
    fmt: str = "csv",
    as_of: dt.date | None = None,
    now: dt.datetime | None = None,
    optimize: bool = False,
    fold: bool = True,
) -> dict[str, SilverResult]:
    """``inputs`` maps entity names to raw paths.  A failing step raises; what was
    committed before it stays valid and the next run carries on from there.

    ``fold`` rewrites the silver tables after their upserts, so that readers find one plain
    table; rows keep the numbers of the commits that brought them."""
    layers = Layers(base)
    for entity, path in inputs.items():
        ingest(spark, path, layers, entity, fmt=fmt, now=now)
    outcome = build_silver(spark, layers, incremental=incremental, now=now)
    if fold:
        fold_upserts(spark, layers, now=now)
    build_gold(spark, layers, as_of=as_of, now=now, optimize=optimize)
    return outcome
