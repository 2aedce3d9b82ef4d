"""Bronze, silver and gold jobs on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverlode import schemas
from silverlode.operators import VersionedTable
from silverlode.plans import gold, ingest, run_batch
from silverlode.plans import silver as silver_jobs
from silverlode.plans.silver import (
    build_silver, newer_than, process_entity, processed_until, transform_customers,
    transform_products, transform_transactions,
)
from silverlode.plans.upkeep import compact_tables, expire_tables, layer_metrics
from silverlode.sources import Layers, read_raw

T = dt.datetime
TX_CSV = """transaction_id,customer_id,product_id,transaction_date,quantity,unit_price,total_amount,discount,final_amount,payment_method,status,shipping_address
T1,C1,P1,2023-05-08 09:15:00,4,12.5,50.0,5.0,45.0,Card, completed ,7 Quay Street
T2,C2,P2,2023-05-08 16:40:00,2,31.0,62.0,0.0,62.0,Transfer,Completed,2 Orchard Way
T3,C1,P3,2023-05-11 12:05:00,1,18.75,18.75,0.0,18.75,Card,pending,7 Quay Street
"""
BAD_CSV = """transaction_id,customer_id,product_id,transaction_date,quantity,unit_price,total_amount,discount,final_amount,payment_method,status,shipping_address
,C1,P1,2024-01-03 10:00:00,1,1.0,1.0,0.0,1.0,Card,completed,x
B2,C1,P1,2024-01-03 10:00:00,0,1.0,1.0,0.0,1.0,Card,completed,x
B3,C1,P1,2024-01-03 10:00:00,1,1.0,1.0,0.0,-50.0,Card,completed,x
B4,C9,P1,2024-01-03 10:00:00,1,1.0,1.0,0.0,1.0,Card,completed,x
B5,C1,P1,2024-01-03 10:00:00,many,1.0,1.0,0.0,1.0,Card,completed,x
"""
CUSTOMER_CSV = """customer_id,customer_name,email,segment,registration_date,country
C1, Runa Vik,RUNA@Example.org ,gold,2019-08-14,norway
C2,Otto Pell,otto@example.org,silver,2020-02-29,chile
C3,Mina Dray,mina@example.org,bronze,2022-11-05,kenya
"""
PRODUCT_CSV = """product_id,product_name,category,price,cost,stock_quantity
P1,Kettle,kitchen,48.40,21.15,73
P2,Whisk,kitchen,6.85,2.30,410
P3,Shelf,storage,0.0,14.60,38
"""


@pytest.fixture
def raw(tmp_path):
    def put(name, text):
        path = tmp_path / "raw" / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
        return str(path)
    return put


@pytest.fixture
def lake(tmp_path):
    return Layers(str(tmp_path / "lake"))


def load(spark, lake, raw, transactions=TX_CSV, name="t1.csv", now=T(2024, 2, 1), references=True):
    if references:
        ingest(spark, raw("c.csv", CUSTOMER_CSV), lake, "customers", now=now)
        ingest(spark, raw("p.csv", PRODUCT_CSV), lake, "products", now=now)
    ingest(spark, raw(name, transactions), lake, "transactions", now=now)


def table(spark, lake, layer, name):
    return VersionedTable(spark, lake.path(layer, name)).read()


# -- bronze ----------------------------------------------------------------------

def test_ingest_adds_lineage_and_appends(spark, lake, raw):
    load(spark, lake, raw, references=False)
    load(spark, lake, raw, references=False)
    rows = table(spark, lake, "bronze", "transactions")
    assert rows.count() == 6
    r = rows.where("transaction_id = 'T1'").first()
    assert r.data_source == "ecommerce" and r.source_file.endswith("t1.csv")
    assert r.ingestion_timestamp == T(2024, 2, 1) and r.ingestion_date == dt.date(2024, 2, 1)
    assert r.transaction_timestamp == T(2023, 5, 8, 9, 15)


def test_catalog_table_shows_the_last_batch_only(spark, lake, raw):
    ingest(spark, raw("a.csv", TX_CSV), lake, "transactions", register_as="bronze_transactions")
    assert spark.table("bronze_transactions").count() == 3
    ingest(spark, raw("b.csv", BAD_CSV), lake, "transactions", register_as="bronze_transactions")
    assert spark.table("bronze_transactions").count() == 5
    assert table(spark, lake, "bronze", "transactions").count() == 8
    spark.sql("drop table bronze_transactions")


def test_unreadable_cells_are_null_and_can_be_kept_as_text(spark, raw):
    path = raw("b.csv", BAD_CSV)
    assert read_raw(spark, path, "transactions").where("quantity is null").count() == 1
    kept = read_raw(spark, path, "transactions", keep_corrupt=True).cache()
    assert kept.where("_corrupt_record like '%many%'").count() == 1
    kept.unpersist()


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_other_raw_formats(spark, raw, tmp_path, fmt):
    path = str(tmp_path / fmt)
    read_raw(spark, raw("a.csv", TX_CSV), "transactions").write.format(fmt).save(path)
    assert read_raw(spark, path, "transactions", fmt=fmt).count() == 3


def test_inferred_schema(spark, raw):
    df = read_raw(spark, raw("p.csv", PRODUCT_CSV), infer=True)
    assert dict(df.dtypes)["price"] == "double" and df.count() == 3


def test_bad_event_time_is_null(spark):
    from silverlode.plans.bronze import with_event_time
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("soon",), (None,)], "transaction_date string")
    assert [r.transaction_timestamp for r in with_event_time(df).collect()] == [T(2024, 1, 1), None, None]


# -- silver ----------------------------------------------------------------------

def test_transaction_transform(spark):
    df = spark.createDataFrame(
        [("1", "  completed ", 2, 30.0, 100.123456, 10.0, 90.125, "2024-01-01 10:00:00"),
         ("2", None, 1, 1.0, 0.0, 5.0, 1.0, "x"),
         ("3", "x", None, 1.0, None, 5.0, 1.0, None)],
        "transaction_id string, status string, quantity int, unit_price double, total_amount double, "
        "discount double, final_amount double, transaction_date string")
    a, b, c = transform_transactions(df).orderBy("transaction_id").collect()
    assert a.status == "COMPLETED" and a.total_amount == 100.12 and a.final_amount == 90.13
    assert a.profit == 54.13                                  # from the unrounded amount: 90.125 - 36
    assert a.discount_percentage == 10.0 / 100.123456 * 100
    assert b.status is None and b.discount_percentage == 0 and b.transaction_timestamp is None
    assert c.discount_percentage == 0 and c.profit is None


def test_customer_and_product_transforms(spark):
    c = transform_customers(spark.createDataFrame(
        [(" Ada Moss ", " A@B.C ", "vip ", " usa")],
        "customer_name string, email string, segment string, country string")).first()
    assert (c.customer_name, c.email, c.segment, c.country) == ("ADA MOSS", "a@b.c", "VIP", "USA")
    rows = transform_products(spark.createDataFrame(
        [(" Fan ", "toys ", 25.999, 10.0), ("Free", "toys", 0.0, 1.0), ("None", "toys", None, 1.0)],
        "product_name string, category string, price double, cost double")).collect()
    assert rows[0].product_name == "Fan" and rows[0].category == "TOYS" and rows[0].price == 26.0
    assert rows[0].profit_margin == 61.54
    assert rows[1].profit_margin == rows[2].profit_margin == 0


def test_incremental_and_full_runs(spark, lake, raw):
    load(spark, lake, raw)
    assert build_silver(spark, lake)["transactions"].accepted == 3
    again = process_entity(spark, lake, "transactions")
    assert (again.accepted, again.rejected) == (0, 0)
    # one more row, carrying the very time of the first batch: it is not skipped
    load(spark, lake, raw, TX_CSV.splitlines()[0] + "\nT4,C2,P1,2024-01-05 10:00:00,1,5.0,5.0,0.0,5.0,Card,completed,x\n",
         "t2.csv", references=False)
    assert process_entity(spark, lake, "transactions").accepted == 1
    assert table(spark, lake, "silver", "transactions").count() == 4
    assert processed_until(spark, lake, "transactions") == T(2024, 2, 1)
    full = process_entity(spark, lake, "transactions", incremental=False)
    assert full.accepted == 4 and table(spark, lake, "silver", "transactions").count() == 4
    assert process_entity(spark, lake, "transactions").accepted == 0


def test_rejects_are_quarantined_once(spark, lake, raw):
    load(spark, lake, raw, BAD_CSV)
    first = process_entity(spark, lake, "transactions")
    assert (first.accepted, first.rejected) == (0, 5)
    assert process_entity(spark, lake, "transactions").rejected == 0      # all-rejected batch is done
    load(spark, lake, raw, TX_CSV, "t2.csv", now=T(2024, 2, 2), references=False)
    assert process_entity(spark, lake, "transactions").accepted == 3
    messages = {r.error_message for r in table(spark, lake, "quarantine", "transactions").collect()}
    assert messages == {"Null values in required fields", "quantity must be >= 1", "final_amount must be >= 0",
                        "Invalid customer_id", "quantity is null"}
    assert table(spark, lake, "quarantine", "transactions").count() == 5
    process_entity(spark, lake, "transactions", incremental=False)
    assert table(spark, lake, "quarantine", "transactions").count() == 5


def test_crash_between_the_two_sinks(spark, lake, raw, monkeypatch):
    load(spark, lake, raw, TX_CSV + "\n".join(BAD_CSV.splitlines()[1:]) + "\n")
    real = VersionedTable.upsert

    def dies(self, *a, **k):
        raise RuntimeError("executor room on fire")

    monkeypatch.setattr(VersionedTable, "upsert", dies)
    with pytest.raises(RuntimeError):
        process_entity(spark, lake, "transactions")
    monkeypatch.setattr(VersionedTable, "upsert", real)
    load(spark, lake, raw, TX_CSV.replace("T1,", "T9,"), "t3.csv", now=T(2024, 2, 3), references=False)
    assert process_entity(spark, lake, "transactions").accepted == 3       # the interrupted batch
    assert process_entity(spark, lake, "transactions").accepted == 3       # the one after it
    assert table(spark, lake, "quarantine", "transactions").count() == 5
    ids = sorted(r.transaction_id for r in table(spark, lake, "silver", "transactions").collect())
    assert ids == ["T1", "T2", "T3", "T9"]


def test_compaction_of_bronze_does_not_replay_it(spark, lake, raw):
    load(spark, lake, raw)
    process_entity(spark, lake, "transactions")
    VersionedTable(spark, lake.path("bronze", "transactions")).compact()
    assert process_entity(spark, lake, "transactions").accepted == 0
    load(spark, lake, raw, TX_CSV.replace("T1,", "T9,"), "t3.csv", now=T(2024, 2, 3), references=False)
    VersionedTable(spark, lake.path("bronze", "transactions")).compact()
    assert process_entity(spark, lake, "transactions").accepted == 3
    assert table(spark, lake, "silver", "transactions").count() == 4


def test_rows_of_any_clock_survive_compaction(spark, lake, raw):
    """Two batches with an equal and an earlier clock come in, bronze is compacted, and
    both are still judged."""
    load(spark, lake, raw, now=T(2024, 2, 2), references=False)
    process_entity(spark, lake, "transactions")
    for i, now in enumerate((T(2024, 2, 2), T(2024, 2, 1))):
        load(spark, lake, raw, TX_CSV.replace("T1,", f"N{i},"), f"n{i}.csv", now=now, references=False)
    VersionedTable(spark, lake.path("bronze", "transactions")).compact()
    assert process_entity(spark, lake, "transactions").accepted + process_entity(spark, lake, "transactions").accepted == 4
    ids = {r.transaction_id for r in table(spark, lake, "silver", "transactions").collect()}
    assert ids == {"T1", "T2", "T3", "N0", "N1"}


def test_dimensions_do_not_pile_up(spark, lake, raw):
    inputs = {"transactions": raw("t.csv", TX_CSV), "customers": raw("c.csv", CUSTOMER_CSV), "products": raw("p.csv", PRODUCT_CSV)}
    for day in (1, 2, 3):
        run_batch(spark, inputs, lake.base, as_of=dt.date(2024, 1, 10), now=T(2024, 2, day))
    for layer, name in (("gold", "dim_customers"), ("gold", "dim_products"), ("silver", "transactions")):
        t = VersionedTable(spark, lake.path(layer, name))
        assert not t.has_pending_upserts()
        assert t.commit_of(t.latest_version()).row_count == t.read().count() == 3


def test_the_mark_does_not_move_back(spark, lake, raw):
    load(spark, lake, raw, now=T(2024, 2, 5), references=False)
    process_entity(spark, lake, "transactions")
    load(spark, lake, raw, TX_CSV.replace("T1,", "T9,"), "t3.csv", now=T(2024, 2, 1), references=False)
    assert process_entity(spark, lake, "transactions").accepted == 3       # older stamp, newer commit
    assert processed_until(spark, lake, "transactions") == T(2024, 2, 5)
    VersionedTable(spark, lake.path("silver", "transactions")).expire(before=dt.datetime(2030, 1, 1))
    assert processed_until(spark, lake, "transactions") == T(2024, 2, 5)


def test_without_reference_tables_the_keys_are_not_checked(spark, lake, raw):
    load(spark, lake, raw, references=False)
    assert process_entity(spark, lake, "transactions").accepted == 3


def test_newer_than_is_strict(spark):
    df = spark.createDataFrame([(T(2024, 1, 1),), (T(2024, 1, 2),), (None,)], "ingestion_timestamp timestamp")
    assert newer_than(df, T(2024, 1, 1)).count() == 1
    assert newer_than(df, None).count() == 3


# -- gold ------------------------------------------------------------------------

SALES_DDL = ("transaction_id string, customer_id string, product_id string, transaction_timestamp timestamp, "
             "final_amount double, quantity int, discount double, profit double, status string")


@pytest.fixture
def sold(spark):
    return spark.createDataFrame([
        ("k1", "C1", "P1", T(2019, 1, 3, 9), 64.5, 3, 0.0, 22.5, "COMPLETED"),
        ("k2", "C2", "P2", T(2019, 1, 3, 14), 131.0, 1, 4.0, 51.0, "COMPLETED"),
        ("k3", "C1", "P1", T(2019, 1, 4, 9), 87.25, 2, 0.0, 30.0, "COMPLETED"),
        ("k4", "C3", "P1", T(2019, 1, 4, 9), 412.0, 5, 0.0, 90.0, "PENDING"),
        ("k5", "C3", "P1", T(2019, 12, 30), 2.5, 1, 0.0, 0.5, "COMPLETED"),
        ("k6", "C3", "P1", T(2019, 1, 4, 9), 7.0, 1, 0.0, 1.0, None),
    ], SALES_DDL)


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_daily_sales(spark, sold):
    days = by(gold.daily_sales(sold), "sale_date")
    assert len(days) == 3
    d = days[dt.date(2019, 1, 3)]
    assert (d.transaction_count, d.total_revenue, d.unique_customers, d.unique_products) == (2, 195.5, 2, 2)
    assert (d.max_transaction_value, d.min_transaction_value, d.avg_transaction_value) == (131.0, 64.5, 97.75)
    assert (d.year, d.month, d.quarter, d.week_number) == (2019, 1, 1, 1)


def test_approximate_distinct_counts(spark, sold):
    exact, near = gold.daily_sales(sold), gold.daily_sales(sold, approximate=True)
    assert exact.drop(gold.STAMP).exceptAll(near.drop(gold.STAMP)).count() == 0      # few values: the sketch is exact


def test_week_is_iso_and_year_is_calendar(sold):
    weeks = by(gold.weekly_sales(sold), "year", "week_number")
    assert weeks[2019, 1].transaction_count == 4             # early January and 30 December
    months = by(gold.monthly_sales(sold), "year", "month", "quarter")
    assert set(months) == {(2019, 1, 1), (2019, 12, 4)}


def test_dimension_metrics(spark, sold):
    people = spark.createDataFrame([("C1", "A"), ("C9", "B")], "customer_id string, customer_name string")
    dim = by(gold.dim_customers(people, gold.customer_metrics(sold)), "customer_id")
    assert dim["C1"].total_revenue == dim["C1"].customer_lifetime_value == 151.75
    assert dim["C1"].first_transaction_date == T(2019, 1, 3, 9)
    assert (dim["C9"].total_transactions, dim["C9"].total_revenue, dim["C9"].last_transaction_date) == (0, 0.0, None)
    bare = gold.dim_customers(people, None)
    assert "last_transaction_date" not in bare.columns and bare.first().total_transactions == 0


def test_metrics_and_attributes_are_joined_without_a_broadcast(spark, sold, tmp_path):
    """Both have a row a key, and their compressed files say little about how large they are."""
    def stored(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    people = spark.createDataFrame([("C1", "A", "GOLD")], "customer_id string, customer_name string, segment string")
    things = spark.createDataFrame([("P1", "Kettle", "KITCHEN", 2.0, 1.0, 5)], "product_id string, product_name string, category string, price double, cost double, stock_quantity int")
    people, things = stored(people, "people"), stored(things, "things")
    bought, moved = stored(gold.customer_metrics(sold), "bought"), stored(gold.product_metrics(sold), "moved")
    for df in (gold.dim_customers(people, bought), gold.customer_segments(bought, people), gold.dim_products(things, moved), gold.product_performance(moved, things)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_product_performance(spark):
    sold = spark.createDataFrame([
        ("k1", "C1", "P1", T(2019, 1, 3), 48.4, 1, 0.0, 27.25, "COMPLETED"),
        ("k2", "C2", "P1", T(2019, 1, 9), 48.4, 3, 0.0, 21.75, "COMPLETED"),
        ("k3", "C1", "P2", T(2019, 2, 3), 0.0, 2, 0.0, 3.5, "COMPLETED")], SALES_DDL)
    goods = spark.createDataFrame(
        [("P1", "Kettle", "K", 48.4, 21.15)], "product_id string, product_name string, category string, price double, cost double")
    perf = by(gold.product_performance(gold.product_metrics(sold), goods), "product_id")
    assert perf["P1"].total_revenue == 96.8 and perf["P1"].total_quantity_sold == 4
    assert perf["P1"].profit_margin == 49.0 / 96.8 * 100
    assert perf["P2"].profit_margin is None and perf["P2"].category is None


@pytest.mark.parametrize("days,n,amount,scores,label", [
    (10, 10, 200.0, (5, 4, 4), "Champions"),
    (30, 20, 250.0, (5, 5, 5), "Champions"),
    (31, 10, 200.0, (4, 4, 4), "Champions"),
    (90, 5, 200.0, (3, 3, 3), "Loyal Customers"),
    (60, 2, 1.0, (4, 2, 1), "At Risk"),
    (91, 5, 100.0, (2, 3, 2), "Lost Customers"),
    (200, 20, 1000.0, (1, 5, 5), "Lost Customers"),
    (61, 1, 5000.0, (3, 1, 5), "Potential Loyalists"),
    (181, 1, 1.0, (1, 1, 1), "Need Attention"),
    (30, 5, 1.0, (5, 3, 1), "Need Attention"),
])
def test_segments(spark, days, n, amount, scores, label):
    as_of = dt.date(2024, 12, 31)
    last = T(2024, 12, 31) - dt.timedelta(days=days)
    sold = spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("C1").alias("customer_id"),
        F.lit(amount).alias("final_amount"), F.lit(last).alias("transaction_timestamp"),
        F.lit("COMPLETED").alias("status"))
    people = spark.createDataFrame([("C1", "Name")], "customer_id string, customer_name string")
    r = gold.customer_segments(gold.customer_metrics(sold), people, as_of).first()
    assert (r.recency_score, r.frequency_score, r.monetary_score) == scores
    assert (r.segment, r.recency_days, r.customer_name, r.original_segment) == (label, days, "Name", None)


def test_dim_dates(spark):
    january = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 31))], "first_day date, last_day date")
    dates = by(gold.dim_dates(january), "date")
    assert len(dates) == 31
    r = dates[dt.date(2024, 1, 6)]
    assert (r.month_name, r.day_name, r.week_number, r.is_weekday, r.year_month, r.date_key) == (
        "January", "Saturday", 1, 0, "2024-01", 20240106)
    nothing = spark.createDataFrame([], "transaction_timestamp timestamp")
    assert gold.dim_dates(gold.day_bounds(nothing)).count() == 366


def test_totals_are_exact_for_cents_and_complete_for_the_rest(spark):
    from silverlode.functions import exact_avg, exact_sum
    def total(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert total(*[0.1] * 10).s == 1.0
    assert total(0.125, 0.125, 1.0).s == 1.25
    assert total(1e200, 1.0).s == 1e200 + 1.0
    assert total(-0.3, 0.1).s == -0.2
    assert total(float("nan"), 1.0).s != total(float("nan"), 1.0).s
    assert total(float("inf"), 1.0).s == float("inf")
    r = total(None, None)
    assert r.s is None and r.a is None
    assert total(None, 2.0).a == 2.0


def test_reports(spark, sold):
    top = gold.top_per_day(sold, "product_id", 1)
    assert {(r.sale_date.day, r.product_id) for r in top.where("month(sale_date) = 1").collect()} == {(3, "P2"), (4, "P1")}
    perf = spark.createDataFrame([("A", 10.0, 4, 1.0), ("A", 5.0, 2, 1.0), (None, 1.0, 1, 1.0)],
                                 "category string, total_revenue double, total_quantity_sold bigint, total_profit double")
    stock = spark.createDataFrame([("A", 3), (None, 0)], "category string, stock_quantity int")
    out = by(gold.category_report(perf, stock), "category")
    assert out["A"].stock_turnover == 2.0 and out[None].stock_turnover is None


# -- all together ----------------------------------------------------------------

def test_whole_batch_and_upkeep(spark, lake, raw):
    inputs = {"transactions": raw("t.csv", TX_CSV + "\n".join(BAD_CSV.splitlines()[1:]) + "\n"),
              "customers": raw("c.csv", CUSTOMER_CSV), "products": raw("p.csv", PRODUCT_CSV)}
    out = run_batch(spark, inputs, lake.base, as_of=dt.date(2024, 1, 10), now=T(2024, 2, 1))
    assert (out["transactions"].accepted, out["transactions"].rejected) == (3, 5)
    from silverlode.sources.layers import TABLES
    assert {n for n in TABLES["gold"]} == {
        n for n in TABLES["gold"] if VersionedTable(spark, lake.path("gold", n)).exists()}
    daily = table(spark, lake, "gold", "daily_sales_summary")
    assert daily.first().total_revenue == 107.0 and daily.first().year == 2023
    assert table(spark, lake, "gold", "dim_customers").count() == 3
    assert table(spark, lake, "gold", "dim_dates").count() == 4
    perf = table(spark, lake, "gold", "product_performance")
    assert dict(perf.dtypes)["category"] == "string" and perf.where("category = 'KITCHEN'").count() == 2
    # the same files again: new bronze rows, the same silver rows
    run_batch(spark, inputs, lake.base, as_of=dt.date(2024, 1, 10), now=T(2024, 2, 2))
    assert table(spark, lake, "silver", "transactions").count() == 3
    assert table(spark, lake, "gold", "dim_customers").count() == 3
    before = {n: table(spark, lake, "silver", n).count() for n in TABLES["silver"]}
    done = compact_tables(spark, lake, {"silver": TABLES["silver"], "gold": ("dim_customers", "no_such")})
    assert [r.done for r in done.collect()] == [True, True, True, True, False]
    assert before == {n: table(spark, lake, "silver", n).count() for n in TABLES["silver"]}
    metrics = layer_metrics(spark, lake)
    assert metrics.where("layer = 'silver' and table = 'transactions' and version = 0").first().rejected == 5
    kept = expire_tables(spark, lake, 1, {"silver": TABLES["silver"]}, now=dt.datetime.now() + dt.timedelta(days=1))
    assert all(r.done for r in kept.collect())
    assert processed_until(spark, lake, "transactions") == T(2024, 2, 2)     # the log still knows
    assert before == {n: table(spark, lake, "silver", n).count() for n in TABLES["silver"]}


def test_command_line(spark, lake, raw, capsys):
    from silverlode.__main__ import main
    base = ["--base", lake.base]
    main(["ingest", *base, "--transactions", raw("t.csv", TX_CSV), "--products", raw("p.csv", PRODUCT_CSV)])
    main(["silver", *base, "--full"])
    main(["restore", *base, "--layer", "silver", "--table", "products", "--version", "0"])
    main(["history", *base, "--layer", "silver", "--table", "products"])
    out = capsys.readouterr().out
    assert "accepted=3" in out and "RESTORE" in out
    with pytest.raises(SystemExit):
        main(["stream", *base])


def test_schemas_are_nullable():
    assert all(f.nullable for s in schemas.RAW.values() for f in s)
    assert [f.name for f in schemas.TRANSACTIONS][:3] == ["transaction_id", "customer_id", "product_id"]
    assert silver_jobs.COST_SHARE == 0.6


def test_layer_paths():
    lake = Layers("/x/")
    assert lake.path("gold", "dim_dates") == "/x/gold/dim_dates"
    assert lake.as_dict() == {n: f"/x/{n}" for n in ("bronze", "silver", "gold", "quarantine")}
    with pytest.raises(ValueError):
        lake.path("lead")
