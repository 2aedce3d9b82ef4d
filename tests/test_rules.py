"""Quality rules: hand-made rows, the counts each rule must give, and invariants."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from silverlode.operators import (
    ForeignKey, NotNull, Parses, Range, Ruleset, Unique, newest_per_key, rank_within_key,
    split_duplicates, split_foreign_key, split_nulls, split_range,
)
from silverlode.operators.dedupe import _may_repeat, _note_repeated
from silverlode.operators.rules import product_rules, stamp_verdict, transaction_rules, verdict_counts

T0 = dt.datetime(2024, 1, 1, 10)


def test_nulls_in_any_listed_column(spark):
    df = spark.createDataFrame(
        [("1", "A", 1), (None, "B", 2), ("3", None, 3), ("4", "", 4)], "id string, name string, age int")
    good, bad = split_nulls(df, ["id", "name"])
    assert (good.count(), bad.count()) == (2, 2)


def test_duplicates_keep_the_newest(spark):
    df = spark.createDataFrame(
        [("1", "old", T0), ("1", "new", T0 + dt.timedelta(hours=1)), ("2", "b", T0), ("3", "c", None)],
        "id string, name string, ingestion_timestamp timestamp")
    kept, displaced = split_duplicates(df, ["id"])
    assert (kept.count(), displaced.count()) == (3, 1)
    assert displaced.first().name == "old"
    assert kept.where("id = '1'").first().name == "new"


def test_null_key_counts_as_one_key_and_null_time_is_oldest(spark):
    df = spark.createDataFrame(
        [(None, "a", T0), (None, "b", None)], "id string, name string, ingestion_timestamp timestamp")
    kept, displaced = split_duplicates(df, ["id"])
    assert kept.first().name == "a" and displaced.first().name == "b"


@pytest.mark.parametrize("low,high,expected", [
    (0, 150, (2, 2)), (0, None, (3, 1)), (None, 150, (3, 1)), (None, None, (4, 0))])
def test_range_bounds_are_inclusive(spark, low, high, expected):
    df = spark.createDataFrame([("1", 0.0), ("2", 150.0), ("3", -5.0), ("4", 200.0)], "id string, price double")
    good, bad = split_range(df, "price", low, high)
    assert (good.count(), bad.count()) == expected


def test_missing_value_in_range_is_rejected_unless_strict(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "price double")
    assert [x.count() for x in split_range(df, "price", 0)] == [1, 2]
    assert [x.count() for x in split_range(df, "price", 0, strict_parity=True)] == [1, 1]


def test_foreign_key_does_not_multiply_rows(spark):
    ref = spark.createDataFrame([("C1", "x"), ("C2", "y"), ("C2", "again")], "customer_id string, name string")
    df = spark.createDataFrame(
        [("T1", "C1"), ("T2", "C2"), ("T3", "C9"), ("T4", None)], "t string, customer_id string")
    good, bad = split_foreign_key(df, "customer_id", ref, "customer_id")
    assert (good.count(), bad.count()) == (2, 2)
    assert good.columns == df.columns


def test_parses_rule(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "q string")
    tagged = Ruleset([Parses("q", "int")]).tag(df)
    assert {r.q: r.error_message for r in tagged.collect()} == {
        "12": None, "x": "q is not a valid int", None: None}


def test_empty_message_is_no_message(spark):
    row = stamp_verdict(spark.range(1), F.lit("")).first()
    assert row.validation_status == "PASSED" and row.error_message is None


def _brute(rows, customers, products):
    """The funnel, row by row: first failure of every row, by position."""
    out, alive = {}, []
    for i, r in enumerate(rows):
        if any(r[k] is None for k in ("transaction_id", "customer_id", "product_id", "final_amount")):
            out[i] = "Null values in required fields"
        else:
            alive.append(i)
    best = {}
    for i in alive:
        r = rows[i]
        rank = (r["ingestion_timestamp"] is not None, r["ingestion_timestamp"] or dt.datetime.min, -r["seq"])
        key = r["transaction_id"]
        if key not in best or rank > best[key][0]:
            best[key] = (rank, i)
    winners = {i for _, i in best.values()}
    for i in alive:
        r = rows[i]
        if i not in winners:
            out[i] = "Duplicate transaction_id"
        elif r["final_amount"] < 0:
            out[i] = "final_amount must be >= 0"
        elif r["quantity"] is None:
            out[i] = "quantity is null"
        elif r["quantity"] < 1:
            out[i] = "quantity must be >= 1"
        elif r["customer_id"] not in customers:
            out[i] = "Invalid customer_id"
        elif r["product_id"] not in products:
            out[i] = "Invalid product_id"
        else:
            out[i] = None
    return out


FIELDS = ["seq", "transaction_id", "customer_id", "product_id", "final_amount", "quantity", "ingestion_timestamp"]
DDL = ("seq int, transaction_id string, customer_id string, product_id string, final_amount double, "
       "quantity int, ingestion_timestamp timestamp")


def _random_rows(seed, n=600):
    rnd = random.Random(seed)

    def pick(values, missing=0.04):
        return None if rnd.random() < missing else rnd.choice(values)

    return [{
        "seq": i,
        # one key holds about a third of the rows
        "transaction_id": pick(["hot"] * 100 + [f"t{k}" for k in range(200)]),
        "customer_id": pick([f"c{k}" for k in range(12)]),
        "product_id": pick([f"p{k}" for k in range(12)]),
        "final_amount": pick([10.0, 20.0, -1.0, 0.0]),
        "quantity": pick([1, 2, 3, 0]),
        "ingestion_timestamp": pick([T0 + dt.timedelta(hours=h) for h in range(5)]),
    } for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_single_pass_equals_the_funnel(spark, seed):
    rows = _random_rows(seed)
    customers, products = {f"c{k}" for k in range(10)}, {f"p{k}" for k in range(10)}
    df = spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], DDL).repartition(5)
    ref_c = spark.createDataFrame([(c,) for c in customers], "customer_id string")
    ref_p = spark.createDataFrame([(p,) for p in products], "product_id string")
    tagged = transaction_rules(ref_c, ref_p, ties=["seq"]).tag(df)
    assert {r.seq: r.error_message for r in tagged.collect()} == _brute(rows, customers, products)


def test_a_key_with_a_third_of_the_rows(spark):
    """Exact copies keep one, and no task of the last ranking holds the key whole."""
    df = spark.range(900).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id)) as k", "1 as v",
        "timestamp'2024-01-01 00:00:00' as ingestion_timestamp").repartition(6)
    ranked = rank_within_key(df, ["k"])
    assert ranked.where("_rank = 1").count() == 601 and ranked.count() == 900
    assert newest_per_key(df, ["k"]).count() == 601


def test_no_job_runs_while_a_plan_is_built(spark):
    df = spark.range(50).selectExpr("cast(id % 7 as string) as product_id", "'x' as product_name", "1.0D as price",
                                    "timestamp'2024-01-01 00:00:00' as ingestion_timestamp")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    product_rules().tag(df)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_strict_parity_drops_missing_range_values(spark):
    df = spark.createDataFrame(
        [("1", "P", 5.0, T0), ("2", "Q", -5.0, T0), ("3", "R", None, T0)],
        "product_id string, product_name string, price double, ingestion_timestamp timestamp")
    assert product_rules().tag(df).count() == 3
    only_range = Ruleset([Range("price", low=0)], strict_parity=True)
    assert only_range.tag(df).count() == 2


def test_newer_bad_row_displaces_older_good_row(spark):
    df = spark.createDataFrame(
        [("1", "P", 5.0, T0), ("1", "P", -5.0, T0 + dt.timedelta(hours=1))],
        "product_id string, product_name string, price double, ingestion_timestamp timestamp")
    good, bad = product_rules().split(df)
    assert good.count() == 0
    assert {r.error_message for r in bad.collect()} == {"Duplicate product_id", "price must be >= 0"}


def test_accepted_and_rejected_are_the_input(spark):
    rows = _random_rows(7)
    df = spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], DDL)
    rules = Ruleset([
        NotNull(["transaction_id"]), Unique(["transaction_id"]), Range("quantity", 1, 2),
        ForeignKey("customer_id", df.select("customer_id").where("customer_id < 'c5'"))])
    good, bad = rules.split(df)
    both = good.unionByName(bad).select(*df.columns)
    assert both.exceptAll(df).count() == 0 and df.exceptAll(both).count() == 0
    counts = {r.error_message: r.row_count for r in verdict_counts(rules.tag(df)).collect()}
    assert sum(counts.values()) == len(rows) and counts[None] == good.count()


def test_rows_without_a_foreign_key_do_not_meet_in_one_task(spark):
    """Rows that need no lookup stay spread, whether or not the lacking values are small enough to broadcast."""
    ref = spark.range(50).select(F.col("id").cast("string").alias("customer_id"))
    rows = spark.range(0, 4000, 1, 8).select("id", F.when(F.col("id") % 4 == 0, (F.col("id") % 100).cast("string")).alias("customer_id"))
    options = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        tagged = Ruleset([ForeignKey("customer_id", ref)]).tag(rows)
        per_task = tagged.where("customer_id IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in per_task) < 2000
        assert tagged.where("validation_status = 'PASSED'").count() == rows.where("customer_id < 50").count()
        assert tagged.count() == 4000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_reference_is_not_broadcast(spark, tmp_path):
    """Its keys are one column of a table whose compressed size says little about them."""
    spark.createDataFrame([("a",), ("b",)], "customer_id string").write.parquet(f"{tmp_path}/ref")
    ref = spark.read.parquet(f"{tmp_path}/ref")
    rows = spark.createDataFrame([("a", 1), ("c", 2), (None, 3)], "customer_id string, v int")
    plan = Ruleset([ForeignKey("customer_id", ref)]).tag(rows)._jdf.queryExecution().executedPlan().toString()
    kinds = [line.split(" [")[0].split()[-1] for line in plan.splitlines() if "Join [" in line and "LeftAnti" in line]
    assert kinds and set(kinds) == {"SortMergeJoin"}


def test_foreign_key_looks_up_values_as_the_join_compares_them(spark):
    ref = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    rows = spark.createDataFrame([("1",), ("01",), ("3",), (None,)], "k string")
    tagged = Ruleset([ForeignKey("k", ref)]).tag(rows)
    assert {r.k: r.validation_status for r in tagged.collect()} == {"1": "PASSED", "01": "PASSED", "3": "FAILED", None: "FAILED"}


def test_whole_rows_are_shuffled_once_to_rank_them(spark, monkeypatch):
    """Keys over the bound are ranked in lanes, the others by their key alone; the survivors are the same."""
    rows = spark.range(0, 600, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise((F.col("id") % 100).cast("string")).alias("k"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") % 7).cast("decimal(18,6)"))).alias("ingestion_timestamp"),
        F.col("id").alias("v"))
    plain = {(r.k, r.v): r._rank == 1 for r in rank_within_key(rows, ["k"]).collect()}
    monkeypatch.setattr("silverlode.operators.dedupe.HOT_ROWS", 20)
    laned = {(r.k, r.v): r._rank == 1 for r in rank_within_key(rows, ["k"]).collect()}
    assert plain == laned and len(plain) == 600
    assert sum(plain.values()) == rows.select("k").distinct().count()
    plan = rank_within_key(rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_rows_alone_with_their_key_are_not_shuffled(spark):
    """Only rows of repeated keys (a NULL is one) reach the window; the ranks are those of a plain window."""
    rows = spark.createDataFrame(
        [(f"k{i}", i) for i in range(300)] + [("k7", 300), ("k7", 301), ("k8", -1), (None, 1), (None, 2), ("", 3)], "k string, v int",
    ).withColumn("ingestion_timestamp", F.lit(T0).cast("timestamp"))
    ranked = rank_within_key(rows, ["k"])
    plain = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("k").orderBy("v")))
    assert sorted(map(str, ranked.select("k", "v", "_rank").collect())) == sorted(map(str, plain.select("k", "v", "_rank").collect()))

    counted = rows.groupBy(F.col("k").alias("_k0")).agg(F.count(F.lit(1)).alias("_n"))
    again = _may_repeat(rows, ["k"], _note_repeated(counted, ["_k0"])).where("_again")
    assert sorted((str(r.k), r.v) for r in again.collect()) == sorted(
        [("k7", 7), ("k7", 300), ("k7", 301), ("k8", 8), ("k8", -1), ("None", 1), ("None", 2)])


def test_keys_that_share_a_bit_are_told_apart(spark, monkeypatch):
    """With two bits most rows of other keys are taken along, and ranked first."""
    monkeypatch.setattr("silverlode.operators.dedupe.NOTED_BITS", 2)
    rows = spark.range(0, 120, 1, 4).select(
        F.least("id", F.lit(100)).alias("a"), (F.col("id") % 2 == 0).alias("b"), F.col("id").alias("v"),
        F.lit(T0).cast("timestamp").alias("ingestion_timestamp"))
    alive = F.col("v") != 110
    ranked = rank_within_key(rows, ["a", "b"], alive=alive)
    plain = rows.where(alive).withColumn("_rank", F.row_number().over(Window.partitionBy("a", "b").orderBy("v")))
    assert {r.v: r._rank for r in ranked.collect()} == {**{r.v: r._rank for r in plain.collect()}, 110: 2}
    assert ranked.count() == 120
