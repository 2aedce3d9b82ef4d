"""The registered queries.  Each runs over its whole input tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.operators import (
    Parses, PartitionedTable, Ruleset, VersionedTable, merge_by_key, newest_per_key, split_duplicates,
    split_foreign_key, split_nulls, split_range,
)
from silverlode.operators.rules import (
    CHECKED_AT, customer_rules, product_rules, split_tagged, transaction_rules, verdict_counts,
)
from silverlode.operators.versioned import VersionNotFound, check_append, compare, compare_changed
from silverlode.plans import daily, gold
from silverlode.plans.batch import run_batch
from silverlode.plans.bronze import ingest, register_latest, with_event_time, with_lineage
from silverlode.plans.silver import (
    high_water_mark, newer_than, process_entity, transform_customers, transform_products, transform_transactions,
)
from silverlode.plans.upkeep import compact_tables, layer_metrics
from silverlode.session import list_names, path_bytes, remove_path, shared_dir
from silverlode.sources import Layers, file_stream, read_raw
from silverlode.sources.files import CORRUPT
from silverlode.streaming import decode_events, ingest_stream, windowed_stream
from silverlode.streaming.events import split_malformed
from workload import canon

NOW = dt.datetime(2024, 1, 1)
AS_OF = dt.date(2001, 8, 2)
STAMPS = ("silver_processed_timestamp", "silver_processed_date", gold.STAMP, CHECKED_AT)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def shown(df: DataFrame) -> DataFrame:
    """Without processing stamps, and with zone-free timestamps."""
    return canon.plain_time(df.drop(*STAMPS))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return transform_transactions(canon.transactions(spark, sf), NOW)


# -- bronze --------------------------------------------------------------------

@query
def bronze_enrich(spark, sf):
    raw = canon.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        # a text that is no time must become NULL
        F.when(F.col("o_orderstatus") == "P", "soon")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("transaction_date"),
        F.regexp_extract(F.col("_metadata.file_path"), r"([a-z]+)\.parquet", 1).alias("file"),
    )
    return shown(with_event_time(with_lineage(raw, F.col("file"), "ecommerce", NOW)).drop("file"))


@query
def raw_csv_scan(spark, sf):
    path = shared_dir(spark, "raw-csv")
    canon.products(spark, sf).withColumn(
        "stock_quantity",                      # cells that are no integers
        F.when(F.col("stock_quantity") > 10, F.lit("many")).otherwise(F.col("stock_quantity").cast("string")),
    ).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return read_raw(spark, path, "products").withColumn("stock_quantity", F.col("stock_quantity").cast("double"))


@query
def json_parse(spark, sf):
    return canon.table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.*")


@query
def json_malformed(spark, sf):
    events = canon.table(spark, sf, "events")
    torn = canon.envelope(events).withColumn(          # some messages arrive cut off
        "value", F.when(F.length("value") % 3 == 0, F.substring("value", 1, 30)).otherwise(F.col("value")))
    good, bad = split_malformed(torn)
    return canon.plain_time(
        bad.select("timestamp", F.col("key").cast("string").alias("key"), "value_text").unionByName(
            good.select("timestamp", F.col("key").cast("string").alias("key"), F.lit("").alias("value_text"))))


@query
def event_decode(spark, sf):
    decoded = decode_events(canon.envelope(canon.table(spark, sf, "events")))
    return shown(with_event_time(decoded).select(
        "kafka_key", "transaction_id", "customer_id", "transaction_timestamp", "final_amount", "status"))


# -- silver --------------------------------------------------------------------

@query
def silver_transactions(spark, sf):
    return shown(silver(spark, sf))


@query
def silver_customers(spark, sf):
    return shown(transform_customers(canon.customers(spark, sf), NOW))


@query
def silver_products(spark, sf):
    return shown(transform_products(canon.products(spark, sf), NOW))


@query
def dq_nulls_valid(spark, sf):
    return shown(split_nulls(canon.flawed_transactions(spark, sf), ["transaction_id", "customer_id", "quantity"])[0])


@query
def dq_nulls_invalid(spark, sf):
    return shown(split_nulls(canon.flawed_transactions(spark, sf), ["transaction_id", "customer_id", "quantity"])[1])


@query
def dq_dedup(spark, sf):
    return shown(newest_per_key(canon.transactions(spark, sf), ["transaction_id"], ties=canon.TIES))


@query
def dq_duplicates(spark, sf):
    return shown(split_duplicates(
        canon.transactions(spark, sf), ["transaction_id"], ties=canon.TIES)[1])


@query
def dq_duplicates_skewed(spark, sf):
    """One key has a third of the rows, others have a few."""
    rows = canon.transactions(spark, sf).withColumn("transaction_id", F.when(
        F.col("shipping_address") == "R", F.lit("hot")).otherwise(F.col("customer_id")))
    ties = [*canon.TIES, "transaction_date", "customer_id", "payment_method"]
    return shown(split_duplicates(rows, ["transaction_id"], ties=ties)[0]).select(
        "transaction_id", "ingestion_timestamp", "product_id", "quantity", "total_amount", "discount")


@query
def dq_range_valid(spark, sf):
    return shown(split_range(canon.flawed_transactions(spark, sf), "quantity", 1, 30)[0])


@query
def dq_range_invalid(spark, sf):
    return shown(split_range(canon.flawed_transactions(spark, sf), "quantity", 1, 30)[1])


@query
def dq_range_strict(spark, sf):
    """Three-valued: rows without a quantity are on neither side."""
    accepted, rejected = split_range(canon.flawed_transactions(spark, sf), "quantity", low=1, strict_parity=True)
    sides = accepted.withColumn("side", F.lit("accepted")).unionByName(rejected.withColumn("side", F.lit("rejected")))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("row_count"))


def _solvent(spark, sf):
    return canon.customers(spark, sf).where("balance >= 0")


def _sizeable(spark, sf):
    return canon.products(spark, sf).where("stock_quantity > 5")


@query
def dq_fk_valid(spark, sf):
    return shown(split_foreign_key(
        canon.transactions(spark, sf), "customer_id", _solvent(spark, sf), "customer_id")[0])


@query
def dq_fk_invalid(spark, sf):
    return shown(split_foreign_key(
        canon.transactions(spark, sf), "customer_id", _solvent(spark, sf), "customer_id")[1])


@query
def dq_type(spark, sf):
    text = canon.table(spark, sf, "orders").select(
        F.col("o_orderkey"), F.substring("o_orderpriority", 1, 2).alias("level"),
        F.regexp_replace("o_orderpriority", "-.*", "").alias("digits"))
    rules = Ruleset([Parses("digits", "int"), Parses("level", "int")])
    return rules.tag(text, NOW).drop(CHECKED_AT)


def _tagged(spark, sf):
    return transaction_rules(
        _solvent(spark, sf), _sizeable(spark, sf), ties=canon.TIES,
    ).tag(canon.flawed_transactions(spark, sf), NOW)


@query
def validate_transactions_valid(spark, sf):
    return shown(split_tagged(_tagged(spark, sf))[0])


@query
def validate_transactions_quarantine(spark, sf):
    return shown(split_tagged(_tagged(spark, sf))[1])


@query
def validate_transactions_counts(spark, sf):
    return verdict_counts(_tagged(spark, sf))


@query
def validate_customers(spark, sf):
    """Every order is a sighting of its customer; the newest counts."""
    seen = canon.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderkey").cast("string").alias("customer_name"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("email"),
        F.col("o_orderdate").cast("timestamp").alias("ingestion_timestamp"))
    return shown(customer_rules(ties=["customer_name"]).tag(seen, NOW))


@query
def validate_products(spark, sf):
    """Every line item is a sighting of its product."""
    seen = canon.table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.nullif("l_returnflag", F.lit("N")).alias("product_name"),
        (F.col("l_extendedprice") - 20000).alias("price"),
        F.col("l_orderkey").alias("seen_in"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("units"),
        F.col("l_shipdate").cast("timestamp").alias("ingestion_timestamp"))
    return shown(product_rules(ties=["seen_in", "line", "price", "units", "product_name"]).tag(seen, NOW))


@query
def incremental_batch(spark, sf):
    return shown(newer_than(canon.transactions(spark, sf), dt.datetime(2000, 1, 1)))


@query
def high_water(spark, sf):
    rows = canon.flawed_transactions(spark, sf)
    accepted, rejected = split_nulls(rows, ["customer_id"])
    return shown(high_water_mark([accepted, rejected]))


@query
def incremental_after_compaction(spark, sf):
    """Three batches, the later two with an equal and an earlier clock, and a compaction of
    bronze before silver looks at them: every id is judged once."""
    layers = Layers(shared_dir(spark, "clocks"))
    bronze = VersionedTable(spark, layers.path("bronze", "transactions"))
    rows = canon.transactions(spark, sf)
    third = F.pmod(F.crc32("transaction_id"), F.lit(3))
    for batch, day in enumerate((2, 2, 1)):
        bronze.append(with_event_time(rows.where(third == batch)).withColumn(
            "ingestion_timestamp", F.lit(dt.datetime(2024, 2, day))))
        if batch == 0:
            process_entity(spark, layers, "transactions", now=NOW)
    bronze.compact()
    process_entity(spark, layers, "transactions", now=NOW)
    silver_rows = VersionedTable(spark, layers.path("silver", "transactions")).read()
    return silver_rows.select("transaction_id", "status")


@query
def full_refresh(spark, sf):
    """A second, full run judges everything again and adds nothing."""
    layers = Layers(shared_dir(spark, "full"))
    goods = canon.products(spark, sf).withColumn("ingestion_timestamp", F.lit(NOW))
    VersionedTable(spark, layers.path("bronze", "products")).append(goods)
    process_entity(spark, layers, "products", now=NOW)
    process_entity(spark, layers, "products", incremental=False, now=NOW)
    return VersionedTable(spark, layers.path("silver", "products")).read().select("product_id", "product_name", "category", "price")


@query
def upsert_orders(spark, sf):
    orders = canon.table(spark, sf, "orders")
    old = orders.where("o_orderdate < timestamp_ntz'1999-01-01'").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    new = orders.where("o_orderdate >= timestamp_ntz'1998-06-01'").select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("o_totalprice"),
        F.col("o_orderpriority").alias("priority"))
    return merge_by_key(old, new, ["o_orderkey"])


# -- gold ----------------------------------------------------------------------

@query
def dim_customers(spark, sf):
    people = transform_customers(canon.customers(spark, sf), NOW)
    return shown(gold.dim_customers(people, gold.customer_metrics(silver(spark, sf)), NOW))


@query
def dim_customers_without_sales(spark, sf):
    return shown(gold.dim_customers(transform_customers(canon.customers(spark, sf), NOW), None, NOW))


@query
def dim_products(spark, sf):
    goods = transform_products(canon.products(spark, sf), NOW)
    return shown(gold.dim_products(goods, gold.product_metrics(silver(spark, sf)), NOW))


@query
def dim_dates(spark, sf):
    orders = canon.table(spark, sf, "orders").select(F.col("o_orderdate").alias("transaction_timestamp"))
    return gold.dim_dates(gold.day_bounds(orders))


@query
def daily_sales(spark, sf):
    return shown(gold.daily_sales(silver(spark, sf), NOW))


@query
def weekly_sales(spark, sf):
    return shown(gold.weekly_sales(silver(spark, sf), NOW))


@query
def monthly_sales(spark, sf):
    return shown(gold.monthly_sales(silver(spark, sf), NOW))


@query
def rfm_segments(spark, sf):
    metrics = gold.customer_metrics(canon.orders_as_transactions(spark, sf))
    people = transform_customers(canon.customers(spark, sf), NOW)
    return shown(gold.customer_segments(metrics, people, AS_OF, NOW))


def _performance(spark, sf):
    goods = transform_products(canon.products(spark, sf), NOW)
    return gold.product_performance(gold.product_metrics(silver(spark, sf)), goods, NOW), goods


@query
def product_performance(spark, sf):
    return shown(_performance(spark, sf)[0])


@query
def category_report(spark, sf):
    return gold.category_report(*_performance(spark, sf))


@query
def top_products_per_day(spark, sf):
    return gold.top_per_day(silver(spark, sf), "product_id", 3)


@query
def top_customers_per_day(spark, sf):
    return gold.top_per_day(silver(spark, sf), "customer_id", 3)


@query
def validated_daily_sales(spark, sf):
    """Validate, standardise, summarise: the way a row takes through the layers."""
    accepted, _ = transaction_rules(
        canon.customers(spark, sf), canon.products(spark, sf), ties=canon.TIES,
    ).split(canon.transactions(spark, sf), NOW)
    return shown(gold.daily_sales(transform_transactions(accepted, NOW), NOW))


@query
def partitioned_gold_read(spark, sf):
    """Write the monthly summary in its layout and read one year of it: the other
    years' directories are not opened."""
    layers = Layers(shared_dir(spark, "gold"))
    gold.write_gold(gold.monthly_sales(silver(spark, sf), NOW), layers, "monthly_sales_summary", NOW)
    return shown(VersionedTable(spark, layers.path("gold", "monthly_sales_summary")).read().where("year = 1997"))


# -- versions ------------------------------------------------------------------

COMMIT_TIMES = [dt.datetime(1997, 1, 1), dt.datetime(1999, 1, 1), dt.datetime(2002, 1, 1)]
_PERIODS = [
    "o_orderdate < timestamp_ntz'1997-01-01'",
    "o_orderdate >= timestamp_ntz'1997-01-01' and o_orderdate < timestamp_ntz'1999-01-01'",
    "o_orderdate >= timestamp_ntz'1999-01-01'",
]


def last_orders(spark, sf) -> VersionedTable:
    """A table of every customer's last order, brought up to date three times."""
    orders = canon.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    table = VersionedTable(spark, shared_dir(spark, "last-orders"))
    for period, moment in zip(_PERIODS, COMMIT_TIMES):
        newest = newest_per_key(orders.where(period), ["o_custkey"], "o_orderdate", ["o_orderkey"])
        table.upsert(newest, ["o_custkey"], check_unique=False, now=moment)
    return table


def order_log(spark, sf) -> VersionedTable:
    """All orders, appended in three commits."""
    orders = canon.table(spark, sf, "orders")
    table = VersionedTable(spark, shared_dir(spark, "order-log"))
    for period, moment in zip(_PERIODS, COMMIT_TIMES):
        table.append(orders.where(period), now=moment)
    return table


@query
def version_as_of(spark, sf):
    return last_orders(spark, sf).read(1)


@query
def version_latest(spark, sf):
    return last_orders(spark, sf).read()


@query
def timestamp_as_of(spark, sf):
    return order_log(spark, sf).read_at(dt.datetime(2000, 6, 1))


@query
def history(spark, sf):
    return canon.plain_time(order_log(spark, sf).history().select(
        "version", "committed_at", "operation", "row_count"))


@query
def restore(spark, sf):
    table = last_orders(spark, sf)
    table.restore(0, now=dt.datetime(2003, 1, 1))
    return table.read()


@query
def version_diff(spark, sf):
    table = last_orders(spark, sf)
    return compare(table.read(0), table.read(2), ["o_custkey"])


@query
def version_diff_repeated_keys(spark, sf):
    """Keys that are missing or come several times on both sides."""
    orders = canon.table(spark, sf, "orders").select(
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("k"), "o_orderkey", "o_totalprice", "o_orderdate", "o_custkey")
    before = orders.where("o_orderdate < timestamp_ntz'1999-01-01'").drop("o_orderdate", "o_custkey")
    after = orders.where("o_custkey % 3 <> 0").drop("o_orderdate", "o_custkey")
    return compare(before, after, ["k"])


@query
def append_check(spark, sf):
    return check_append(order_log(spark, sf), 0, 2)


@query
def evolve_schema(spark, sf):
    table = order_log(spark, sf)
    table.add_columns({"review_round": 7, "is_archived": True, "o_custkey": 0})
    return table.read()


@query
def change_feed(spark, sf):
    return last_orders(spark, sf).changes(after=0)


@query
def change_feed_restore(spark, sf):
    """Appends, a compaction (which changes nothing) and a restore of the first version."""
    table = order_log(spark, sf)
    table.compact()
    table.restore(0)
    return table.changes(after=1).select("o_orderkey", "o_totalprice", "_version", "_change")


@query
def compact(spark, sf):
    table = order_log(spark, sf)
    table.compact()
    return table.read()


@query
def zorder(spark, sf):
    table = order_log(spark, sf)
    table.compact(target_bytes=1 << 20, zorder_by=["o_custkey", "o_orderdate"])
    return table.read()


@query
def zorder_text(spark, sf):
    """Clustering on text whose values all begin alike: the rows, and in how many files a
    key can lie by the files' ranges."""
    table = VersionedTable(spark, shared_dir(spark, "text-ids"))
    rows = canon.table(spark, sf, "orders").select(F.format_string("TXN_%010d", "o_orderkey").alias("id"), "o_totalprice")
    table.append(rows)
    table.compact(target_bytes=1 << 15, zorder_by=["id"])
    files = table.read().groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("id").alias("low"), F.max("id").alias("high"))
    spans = files.agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("s"))      # one entry a file
    alone = F.expr("forall(zip_with(slice(s, 1, size(s) - 1), slice(s, 2, size(s)), (x, y) -> x.high < y.low), x -> x)")
    return table.read().agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_totalprice").cast("decimal(20,2)").cast("string").alias("total")) \
        .withColumn("one_file_per_key", F.lit(spans.select(alone.alias("x")).first().x))


@query
def expire_versions(spark, sf):
    """What can still be read after compaction and expiry, and how many rows it has."""
    table = last_orders(spark, sf)
    table.compact(now=dt.datetime(2002, 2, 1))
    table.expire(before=dt.datetime(2002, 3, 1))
    out = None
    for version in range(4):
        try:
            row = table.read(version).agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("checksum"))
        except VersionNotFound:
            continue
        row = row.select(F.lit(version).alias("version"), "row_count", "checksum")
        out = row if out is None else out.unionByName(row)
    return out


# -- streams -------------------------------------------------------------------

def _event_stream(spark, sf):
    schema = canon.table(spark, sf, "events").schema
    return canon.envelope(file_stream(spark, sf, schema=schema, glob="events.parquet"))


def _run(query) -> None:
    query.awaitTermination()


@query
def stream_ingest(spark, sf):
    where = shared_dir(spark, "stream-ingest")
    _run(ingest_stream(_event_stream(spark, sf), f"{where}/table", f"{where}/checkpoint", every=None, now=NOW))
    return shown(VersionedTable(spark, f"{where}/table").read().select(
        "kafka_key", "transaction_id", "customer_id", "transaction_timestamp", "final_amount", "status",
        "source_file", "data_source", "ingestion_date"))


@query
def stream_malformed(spark, sf):
    """Some messages arrive cut off: their text is kept, the others go on."""
    where = shared_dir(spark, "stream-torn")
    torn = _event_stream(spark, sf).withColumn(
        "value", F.when(F.length("value") % 3 == 0, F.substring("value", 1, 30)).otherwise(F.col("value")))
    _run(ingest_stream(torn, f"{where}/table", f"{where}/checkpoint", every=None, now=NOW, malformed_path=f"{where}/torn"))
    good = VersionedTable(spark, f"{where}/table").read().select("transaction_id", F.lit(None).cast("string").alias("value_text"))
    bad = VersionedTable(spark, f"{where}/torn").read().select(F.lit(None).cast("string").alias("transaction_id"), "value_text")
    return good.unionByName(bad)


def _totals(spark, sf, mode):
    where = shared_dir(spark, f"stream-{mode}")
    _run(windowed_stream(_event_stream(spark, sf), f"{where}/table", f"{where}/checkpoint",
                         window="1 hour", every=None, mode=mode))
    return shown(VersionedTable(spark, f"{where}/table").read().drop("status_key"))


@query
def stream_window_append(spark, sf):
    return _totals(spark, sf, "append")


@query
def stream_window_update(spark, sf):
    return _totals(spark, sf, "update")


# -- all layers ----------------------------------------------------------------

# Fixed value: rows of a compressed raw file, which one task reads.
FEED_ROWS = 500_000


def _batch(spark, sf) -> Layers:
    """Raw, compressed CSV files of the three entities, taken through bronze, silver and gold."""
    root = shared_dir(spark, "batch")
    raw = {
        "transactions": canon.transactions(spark, sf).drop("ingestion_timestamp"),
        "customers": _solvent(spark, sf).drop("balance"),
        "products": canon.products(spark, sf),
    }
    inputs = {}
    for name, df in raw.items():
        inputs[name] = f"{root}/raw/{name}"
        df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).option("compression", "gzip").option("maxRecordsPerFile", FEED_ROWS).csv(inputs[name])
    run_batch(spark, inputs, f"{root}/lake", as_of=AS_OF, now=NOW)
    return Layers(f"{root}/lake")


@query
def batch_run_daily_counts(spark, sf):
    """Gold day counts of a whole batch.  Copies of a transaction id arrive at the
    same time here, so only what does not depend on the survivor is shown."""
    layers = _batch(spark, sf)
    days = VersionedTable(spark, layers.path("gold", "daily_sales_summary")).read()
    return days.select("sale_date", "transaction_count", "unique_customers", "year", "month", "week_number")


@query
def dim_customers_two_runs(spark, sf):
    """The written dimension after two runs: one row a customer, nothing pending."""
    layers = Layers(shared_dir(spark, "dims"))
    people = transform_customers(canon.customers(spark, sf), NOW)
    metrics = gold.customer_metrics(silver(spark, sf))
    for _ in range(2):
        version = gold.write_gold(gold.dim_customers(people, metrics, NOW), layers, "dim_customers", NOW)
    table = VersionedTable(spark, layers.path("gold", "dim_customers"))
    return shown(table.read()).withColumn("rows_written", F.lit(table.commit_of(version).row_count).cast("bigint"))


@query
def batch_run_daily(spark, sf):
    """The written day summary of a whole batch, amounts included: of copies that arrive together
    the first by all columns in order survives."""
    return shown(VersionedTable(spark, _batch(spark, sf).path("gold", "daily_sales_summary")).read())


@query
def batch_run_metrics(spark, sf):
    """Rows written per table by a whole batch."""
    return layer_metrics(spark, _batch(spark, sf)).select(
        "layer", "table", "operation", "row_count",
        *[F.coalesce(c, F.lit(-1)).cast("bigint").alias(c) for c in ("accepted", "rejected")])   # -1: not counted


# -- partition by partition ------------------------------------------------------

@query
def upsert_touches_few(spark, sf):
    """Orders by month, merged with changes to the last months and with orders that move there from an
    earlier one: which partitions were written, and the rows."""
    orders = canon.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    table = PartitionedTable(spark, shared_dir(spark, "by-month"), F.trunc("o_orderdate", "month"), ["o_orderkey"])
    table.merge(orders)
    files = {r.f for r in table.read().select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    late = orders.where("o_orderdate >= timestamp_ntz'2001-06-01'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    moved = orders.where("o_orderdate >= timestamp_ntz'1998-03-01' and o_orderdate < timestamp_ntz'1998-04-01' and o_custkey % 7 = 0") \
        .withColumn("o_orderdate", F.expr("timestamp_ntz'2001-07-15'"))
    written = table.merge(late.unionByName(moved))
    return table.read().withColumn("rewritten", ~F.col("_metadata.file_path").isin(list(files))).withColumns({
        "parts_written": F.lit(len(written)).cast("bigint"), "parts_held": F.lit(len(table.parts())).cast("bigint")})


@query
def gold_after_three_batches(spark, sf):
    """Day, week and month summaries that three batches added to; later batches replace rows of earlier ones."""
    layers = Layers(shared_dir(spark, "by-days"))
    bronze = VersionedTable(spark, layers.path("bronze", "transactions"))
    rows = with_event_time(canon.transactions(spark, sf))
    for flag in ("A", "N", "R"):
        bronze.append(rows.where(F.col("shipping_address") == flag))
        daily.advance(spark, layers, as_of=AS_OF, now=NOW, grain="month")
    out = None
    for name, number in (("daily", F.dayofyear("sale_date")), ("weekly", F.col("week_number")), ("monthly", F.col("month"))):
        table = VersionedTable(spark, layers.path("gold", f"{name}_sales_summary")).read()
        part = table.select(F.lit(name).alias("summary"), "year", number.alias("number"), "transaction_count", "unique_customers", "unique_products",
                            "total_revenue", "total_quantity_sold", "avg_transaction_value", "total_profit")
        out = part if out is None else out.unionByName(part)
    return out


# -- streams in several batches ----------------------------------------------------

# Fixed value: how much of the events' file a batch is made of for each file it comes in.
FILE_BYTES = 4 << 20


def _batched_events(spark, sf, where: str):
    """The events in six batches of equally many files: every tenth event comes two batches late."""
    events = canon.table(spark, sf, "events")
    n = events.agg(F.max("event_id")).first()[0] + 1
    batch = F.least(F.expr(f"event_id * 6 div {n}") + F.when(F.col("event_id") % 10 == 0, 2).otherwise(0), F.lit(5))
    files = max(1, -(-path_bytes(spark, f"{sf.rstrip('/')}/events.parquet") // FILE_BYTES))

    def held() -> int:
        return sum(name.endswith(".parquet") for name in list_names(spark, f"{where}/bus"))

    for i in range(6):
        rows = canon.envelope(events.where(batch == i))
        (rows.repartition(files) if files > 1 else rows.coalesce(1)).write.mode("append").parquet(f"{where}/bus")
        for _ in range(files * (i + 1) - held()):            # a task without rows writes no file
            rows.where("false").coalesce(1).write.mode("append").parquet(f"{where}/bus")
    return file_stream(spark, f"{where}/bus", max_files=files)


@query
def stream_late_rows(spark, sf):
    """Totals leave out what comes behind the watermark."""
    where = shared_dir(spark, "stream-late")
    _run(windowed_stream(_batched_events(spark, sf, where), f"{where}/table", f"{where}/checkpoint", window="1 hour", every=None))
    return shown(VersionedTable(spark, f"{where}/table").read().drop("status_key"))


@query
def stream_replay(spark, sf):
    """Both jobs die before their last batch is noted as done (one leaves a torn commit as well) and start again:
    every event is there once, and every total is that of one pass."""
    where = shared_dir(spark, "stream-replay")
    bus = _batched_events(spark, sf, where)
    for again in (False, True):
        _run(ingest_stream(bus, f"{where}/rows", f"{where}/ck-rows", every=None, now=NOW))
        _run(windowed_stream(bus, f"{where}/totals", f"{where}/ck-totals", window="1 hour", every=None))
        for ck in () if again else ("ck-rows", "ck-totals"):
            last = max(int(n) for n in list_names(spark, f"{where}/{ck}/commits") if n.isdigit())
            for name in (f"{last}", f".{last}.crc"):
                remove_path(spark, f"{where}/{ck}/commits/{name}")
        if not again:
            VersionedTable(spark, f"{where}/rows").read().limit(5).write.parquet(f"{where}/rows/data/_commit=9-torn")
    rows = VersionedTable(spark, f"{where}/rows").read().select("transaction_id", F.lit(None).cast("timestamp_ntz").alias("window_start"),
                                                               "status", F.lit(1).cast("bigint").alias("transaction_count"))
    totals = canon.plain_time(VersionedTable(spark, f"{where}/totals").read()).select(
        F.lit(None).cast("string").alias("transaction_id"), "window_start", "status", "transaction_count")
    return rows.unionByName(totals)


@query
def stream_metrics(spark, sf):
    """What each batch of an ingesting stream brought, kept once though the last batch comes twice."""
    where = shared_dir(spark, "stream-metrics")
    bus = _batched_events(spark, sf, where)
    for again in (False, True):
        _run(ingest_stream(bus, f"{where}/rows", f"{where}/ck", every=None, now=NOW, metrics_path=f"{where}/metrics"))
        last = max(int(n) for n in list_names(spark, f"{where}/ck/commits") if n.isdigit())
        for name in () if again else (f"{last}", f".{last}.crc"):
            remove_path(spark, f"{where}/ck/commits/{name}")
    return canon.plain_time(VersionedTable(spark, f"{where}/metrics").read()).select(
        "batch_id", "n_rows", "n_incomplete", "first_time", "last_time")


# -- kept text, kept batches, images, sketches --------------------------------------

@query
def csv_quarantine(spark, sf):
    """Raw rows whose cells do not fit go to quarantine with their text; the others to silver."""
    root = shared_dir(spark, "bad-csv")
    canon.products(spark, sf).withColumn("stock_quantity", F.when(F.col("stock_quantity") > 40, F.lit("many")).otherwise(
        F.col("stock_quantity").cast("string"))).write.option("header", True).csv(f"{root}/raw")
    layers = Layers(f"{root}/lake")
    ingest(spark, f"{root}/raw", layers, "products", keep_corrupt=True, now=NOW)
    process_entity(spark, layers, "products", now=NOW)
    good = VersionedTable(spark, layers.path("silver", "products")).read()
    bad = VersionedTable(spark, layers.path("quarantine", "products")).read()
    text = F.col(CORRUPT).startswith(F.concat("product_id", F.lit(","))) & F.col(CORRUPT).contains("many")
    return good.select("product_id", F.lit(None).cast("string").alias("error_message"), F.lit(False).alias("text_kept"), (F.lit(CORRUPT).isin(good.columns)).alias("in_silver")) \
        .unionByName(bad.select("product_id", "error_message", text.alias("text_kept"), F.lit(False).alias("in_silver")))


@query
def named_table_after_expire(spark, sf):
    """The catalog table of the last batch, after its versions were compacted and expired."""
    root, name = shared_dir(spark, "named"), "latest_orders"
    orders = canon.table(spark, sf, "orders")
    table = VersionedTable(spark, f"{root}/orders")
    for period in _PERIODS:
        version = table.append(orders.where(period))
    register_latest(table, version, name, f"{root}/named")
    table.compact()
    table.expire(before=dt.datetime.now() + dt.timedelta(days=1))
    return spark.table(name)


@query
def change_feed_images(spark, sf):
    """Every upserted row beside what its key held before."""
    return last_orders(spark, sf).images(after=0).select(
        "o_custkey", "_version", F.col("before.o_orderkey").alias("o_orderkey_before"), F.col("after.o_orderkey").alias("o_orderkey_after"),
        (F.col("after.o_totalprice") - F.col("before.o_totalprice")).alias("more"))


@query
def distinct_rollup(spark, sf):
    """Exact distinct counts per month, and whether those from the days' sketches are within the stated bound."""
    rows = silver(spark, sf)
    month = {"year": F.year("sale_date"), "month": F.month("sale_date")}
    about = gold.approximate_uniques(gold.daily_sketches(rows), month).withColumnsRenamed(
        {"unique_customers": "customers_about", "unique_products": "products_about"})
    exact = gold.monthly_sales(rows, NOW).select("year", "month", "unique_customers", "unique_products")
    near = [(F.abs(F.col(f"{n}_about") - F.col(f"unique_{n}")) <= F.greatest(F.lit(1), F.ceil(gold.SKETCH_ERROR * F.col(f"unique_{n}")))).alias(f"{n}_within")
            for n in ("customers", "products")]
    return exact.join(about, ["year", "month"]).select(*exact.columns, *near)


# -- columns without a rewrite, comparison of what differs, raw formats -----------------

@query
def evolve_schema_in_place(spark, sf):
    """Columns added between appends: how many rows that wrote, older rows with the values, later ones with
    their own or none."""
    orders = canon.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    table = VersionedTable(spark, shared_dir(spark, "widened"))
    table.append(orders.where(_PERIODS[0]))
    added = table.add_columns({"review_round": 7, "note": "it's new", "since": dt.date(2024, 1, 2), "share": 0.5})
    table.append(orders.where(_PERIODS[1]))
    table.append(orders.where(_PERIODS[2]).withColumn("review_round", F.lit(8)))
    return table.read().withColumns({
        "since": F.col("since").cast("string"), "rows_written": F.lit(table.commit_of(added).row_count).cast("bigint")})


@query
def version_diff_few_changed(spark, sf):
    """All line items against a state in which a few orders were priced anew, dropped or are new: equal
    parts are told by their digests."""
    lines = canon.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    few = F.pmod(F.col("l_orderkey"), F.lit(500))
    after = lines.where(few != 1).withColumns({
        "l_extendedprice": F.when(few == 2, F.col("l_extendedprice") * 2).otherwise(F.col("l_extendedprice")),
        "l_orderkey": F.when(few == 3, -F.col("l_orderkey")).otherwise(F.col("l_orderkey"))})
    # as many buckets as keep a dozen rows each, whatever the size
    buckets = max(64, lines.count() // 12)
    found = compare_changed(lines, after, ["l_orderkey", "l_linenumber"], buckets)
    return found.withColumn("few_compared", F.col("buckets_compared") * 5 < F.col("buckets_held")).drop("buckets_compared", "buckets_held")


@query
def raw_csv_inferred(spark, sf):
    """A feed whose columns are not declared."""
    path = shared_dir(spark, "raw-inferred")
    canon.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate") \
        .write.option("header", True).csv(path)
    return shown(read_raw(spark, path, infer=True))


@query
def bronze_formats_by_day(spark, sf):
    """A day's batch of JSON lines and a later day's Parquet files in one bronze table: what each day holds."""
    root = shared_dir(spark, "raw-formats")
    layers = Layers(f"{root}/lake")
    goods = canon.products(spark, sf)
    goods.where("stock_quantity <= 20").write.json(f"{root}/json")
    goods.where("stock_quantity > 20").write.parquet(f"{root}/parquet")
    for day, fmt in enumerate(("json", "parquet"), 1):
        ingest(spark, f"{root}/{fmt}", layers, "products", fmt=fmt, now=dt.datetime(2024, 1, day))
    return VersionedTable(spark, layers.path("bronze", "products")).read().select(
        "product_id", "product_name", "category", "price", "cost", F.col("stock_quantity").cast("double").alias("stock_quantity"), "ingestion_date")


@query
def layer_compaction(spark, sf):
    """Compaction of a whole layer: a table that is not there is reported, not an error; rows stay, files get fewer."""
    layers = Layers(shared_dir(spark, "upkeep"))
    for name, rows in (("customers", canon.customers(spark, sf)), ("products", canon.products(spark, sf))):
        table = VersionedTable(spark, layers.path("bronze", name))
        for part in range(3):
            table.append(rows.where(F.pmod(F.crc32(rows[0]), F.lit(3)) == part).repartition(4))
    outcome = compact_tables(spark, layers, {"bronze": ["customers", "products", "transactions"]})
    held = None
    for name in ("customers", "products"):
        now = VersionedTable(spark, layers.path("bronze", name)).read().select(F.col("_metadata.file_path").alias("f")).agg(
            F.count(F.lit(1)).alias("row_count"), F.count_distinct("f").alias("files")).withColumn("table", F.lit(name))
        held = now if held is None else held.unionByName(now)
    return outcome.join(held, "table", "left").select("layer", "table", "done", "version", "problem", "row_count", "files")
