"""Bronze into silver: validate, standardise, merge; rejects go to quarantine."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode import schemas
from silverlode.functions import lower_clean, money, parse_event_time, percent_of, trimmed, upper_clean
from silverlode.functions.time import clock
from silverlode.operators.rules import (
    FAILED, PASSED, STATUS, Readable, Ruleset, customer_rules, product_rules, transaction_rules,
)
from silverlode.operators.versioned import VersionedTable
from silverlode.session import Stage
from silverlode.sources.files import CORRUPT
from silverlode.sources.layers import Layers

# Fixed value: share of the list price assumed to be cost.
COST_SHARE = 0.6


def _stamps(now: dt.datetime | None) -> dict:
    return {
        "silver_processed_timestamp": clock(now),
        "silver_processed_date": clock(now).cast("date"),
    }


def transform_transactions(df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """All right-hand sides see the incoming columns: profit and the discount share
    are taken from unrounded amounts."""
    final, total, discount = F.col("final_amount"), F.col("total_amount"), F.col("discount")
    cost = F.col("unit_price") * F.col("quantity") * COST_SHARE
    return df.withColumns({
        "status": upper_clean("status"),
        "profit": money(final - cost),
        "discount_percentage": percent_of(discount, total),
        "final_amount": money(final),
        "total_amount": money(total),
        "discount": money(discount),
        "transaction_timestamp": parse_event_time("transaction_date"),
        **_stamps(now),
    })


def transform_customers(df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    return df.withColumns({
        "customer_name": upper_clean("customer_name"),
        "email": lower_clean("email"),
        "segment": upper_clean("segment"),
        "country": upper_clean("country"),
        **_stamps(now),
    })


def transform_products(df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    price, cost = F.col("price"), F.col("cost")
    return df.withColumns({
        "product_name": trimmed("product_name"),
        "category": upper_clean("category"),
        "profit_margin": money(percent_of(price - cost, price)),
        "price": money(price),
        "cost": money(cost),
        **_stamps(now),
    })


_TRANSFORM = {
    "transactions": transform_transactions,
    "customers": transform_customers,
    "products": transform_products,
}


def newer_than(df: DataFrame, mark: dt.datetime | None, column: str = "ingestion_timestamp") -> DataFrame:
    """Rows strictly after the mark; without a mark all rows."""
    return df if mark is None else df.where(F.col(column) > F.lit(mark))


def high_water_mark(frames: list[DataFrame], column: str = "ingestion_timestamp") -> DataFrame:
    """One row: the newest value any of the frames has seen (NULL if none has)."""
    seen = [f.select(F.col(column).alias("mark")) for f in frames]
    out = seen[0]
    for f in seen[1:]:
        out = out.unionByName(f)
    return out.agg(F.max("mark").alias("mark"))


def processed_until(spark: SparkSession, layers: Layers, entity: str) -> dt.datetime | None:
    """The high-water mark of an entity.

    Every silver commit notes the newest ingestion time seen so far, rejects
    included, so the log answers this without a scan, and a batch of nothing but
    rejects counts as done.
    """
    silver = VersionedTable(spark, layers.path("silver", entity))
    if not silver.exists():
        return None
    noted = silver.log().select(F.timestamp_micros(_noted_mark()).alias("seen"))
    return high_water_mark([noted], "seen").first().mark


def _noted_mark() -> Column:
    return F.get_json_object("metrics", f"$.{_MARK}").cast("bigint")


@dataclass(frozen=True)
class SilverResult:
    accepted: int
    rejected: int


# Name of the mark in a commit's metrics, and of this job as a writer.
_MARK = "newest_ingestion_micros"
_WRITER = "bronze-to-silver"


def process_entity(
    spark: SparkSession,
    layers: Layers,
    entity: str,
    incremental: bool = True,
    strict_parity: bool = False,
    now: dt.datetime | None = None,
) -> SilverResult:
    """One entity from bronze to silver and quarantine.

    The verdict is worked out once and written to the shared work area, split by
    status; the two sinks read their own part of it.

    Both sinks note the bronze version they cover, and an incremental run takes the
    commits after it.  Quarantine is written first and silver, whose commit counts
    as the mark, last.  If a job dies in between, the next one finds quarantine
    ahead, repeats exactly that batch (the quarantine append is then a no-op) and
    leaves later bronze commits to the run after.

    A full run judges all of bronze again and replaces the quarantine table.
    """
    bronze = VersionedTable(spark, layers.path("bronze", entity))
    silver = VersionedTable(spark, layers.path("silver", entity))
    quarantine = VersionedTable(spark, layers.path("quarantine", entity))

    upto = bronze.latest_version()
    done = silver.last_batch(_WRITER)
    if incremental:
        pending = quarantine.last_batch(_WRITER)
        if pending is not None and (done is None or pending > done):
            upto = pending
    if incremental and done is not None:
        rows = bronze.read_since(done, upto)      # by commit, whatever the clocks said
    else:
        rows = bronze.read(upto)
    if rows is None or rows.isEmpty():
        return SilverResult(0, 0)

    tagged = readable_first(_rules(spark, layers, entity, strict_parity), rows).tag(rows, now)
    guard = {"writer": _WRITER, "batch": upto, "replay": not incremental, "now": now}
    watch = {
        _MARK: F.unix_micros(F.max("ingestion_timestamp")),
        "accepted": F.count(F.when(F.col(STATUS) == PASSED, 1)),
        "rejected": F.count(F.when(F.col(STATUS) == FAILED, 1)),
    }
    with Stage(tagged, f"verdicts-{entity}", partition_by=[STATUS], metrics=watch) as stage:
        seen = stage.metrics
        rejected = stage.read().where(F.col(STATUS) == FAILED)
        if not incremental:
            quarantine.overwrite(rejected, operation="QUARANTINE", **guard)
        elif seen["rejected"]:
            quarantine.append(rejected, operation="QUARANTINE", **guard)
        accepted = stage.read().where(F.col(STATUS) == PASSED).drop(CORRUPT)
        silver.upsert(
            _TRANSFORM[entity](accepted, now), schemas.KEYS[entity], check_unique=False,
            facts={**{k: seen[k] for k in watch}, _MARK: _latest(silver, seen[_MARK])}, **guard)
    return SilverResult(seen["accepted"], seen["rejected"])


def _latest(silver: VersionedTable, batch_mark: int | None) -> int | None:
    """The mark after a batch: a batch of older rows does not move it back."""
    before = silver.log().agg(F.max(_noted_mark()).alias("m")).first().m if silver.exists() else None
    return max((m for m in (before, batch_mark) if m is not None), default=None)


def readable_first(rules: Ruleset, rows: DataFrame) -> Ruleset:
    """Where bronze keeps the text of unreadable rows, that is what they are rejected for."""
    if CORRUPT not in rows.columns:
        return rules
    return Ruleset([Readable(CORRUPT), *rules.rules], rules.strict_parity, rules.extra)


def _rules(spark: SparkSession, layers: Layers, entity: str, strict_parity: bool):
    if entity == "customers":
        return customer_rules()
    if entity == "products":
        return product_rules(strict_parity=strict_parity)
    references = {}
    for name in ("customers", "products"):
        table = VersionedTable(spark, layers.path("bronze", name))
        if table.exists():                    # no reference table, no check
            references[name] = table.read()
    return transaction_rules(references.get("customers"), references.get("products"),
                             strict_parity=strict_parity)


def build_silver(
    spark: SparkSession, layers: Layers, incremental: bool = True, strict_parity: bool = False,
    now: dt.datetime | None = None,
) -> dict[str, SilverResult]:
    return {
        entity: process_entity(spark, layers, entity, incremental, strict_parity, now)
        for entity in ("transactions", "customers", "products")
        if VersionedTable(spark, layers.path("bronze", entity)).exists()
    }
