"""Silver and gold by days against a rebuild of everything."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverlode.operators import VersionedTable
from silverlode.plans import daily, gold
from silverlode.plans.bronze import with_event_time
from silverlode.sources import Layers

T = dt.datetime
SCHEMA = ("transaction_id string, customer_id string, product_id string, transaction_date string, quantity int, unit_price double, "
          "total_amount double, discount double, final_amount double, payment_method string, status string, shipping_address string, "
          "ingestion_timestamp timestamp")


def tx(i, day, customer="C1", product="P1", amount=10.0, status="completed", when=1, quantity=1):
    return (f"T{i}", customer, product, f"{day} 10:00:00", quantity, amount, amount, 0.5, amount, "Card", status, "x", T(2024, 5, when))


@pytest.fixture
def lake(spark, tmp_path):
    layers = Layers(str(tmp_path / "lake"))
    rows = {"customers": spark.createDataFrame([(c, f"N{c}", "a@b", "S", "x") for c in ("C1", "C2", "C3")],
                                               "customer_id string, customer_name string, email string, segment string, country string"),
            "products": spark.createDataFrame([(p, p, "Cat", 10.0, 4.0, 5) for p in ("P1", "P2")],
                                              "product_id string, product_name string, category string, price double, cost double, stock_quantity int")}
    for name, df in rows.items():
        df = df.withColumn("ingestion_timestamp", F.lit(T(2024, 1, 1)))
        VersionedTable(spark, layers.path("bronze", name)).append(df)
        VersionedTable(spark, layers.path("silver", name)).append(df)
    return layers


def send(spark, lake, *rows):
    VersionedTable(spark, lake.path("bronze", "transactions")).append(with_event_time(spark.createDataFrame(list(rows), SCHEMA)))


def run(spark, lake):
    return daily.advance(spark, lake, as_of=dt.date(2024, 4, 1), now=T(2024, 5, 9))


def plain(df):
    df = df.drop(gold.STAMP, "silver_processed_timestamp", "silver_processed_date")
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def check(spark, lake):
    """Every gold table is what a rebuild from silver gives."""
    silver = daily.silver_days(spark, lake).read()
    read = lambda layer, name: VersionedTable(spark, lake.path(layer, name)).read()
    customers, products = read("silver", "customers"), read("silver", "products")
    buyers, goods = gold.customer_metrics(silver), gold.product_metrics(silver)
    for name, want in {
            "daily_sales_summary": gold.daily_sales(silver), "weekly_sales_summary": gold.weekly_sales(silver),
            "monthly_sales_summary": gold.monthly_sales(silver), "dim_customers": gold.dim_customers(customers, buyers),
            "dim_products": gold.dim_products(products, goods), "product_performance": gold.product_performance(goods, products),
            "customer_segments": gold.customer_segments(buyers, customers, dt.date(2024, 4, 1))}.items():
        assert plain(read("gold", name)) == plain(want), name


def test_batches_add_up(spark, lake):
    send(spark, lake, tx(1, "2024-03-01"), tx(2, "2024-03-01", "C2", "P2", 7.25), tx(3, "2024-03-04", "C1", "P2", 3.1),
         tx(4, "2024-03-04", status="pending"), tx(5, "2024-03-09", quantity=0))
    assert run(spark, lake) == ["p2024-03-01", "p2024-03-04"]
    check(spark, lake)
    # a new day, a sale withdrawn, a sale that moves to another day and customer
    send(spark, lake, tx(6, "2024-04-02", "C3", when=2), tx(2, "2024-03-01", "C2", "P2", 7.25, "cancelled", when=2),
         tx(3, "2024-03-05", "C3", "P2", 3.2, when=2))
    assert run(spark, lake) == ["p2024-03-01", "p2024-03-04", "p2024-03-05", "p2024-04-02"]
    check(spark, lake)
    days = VersionedTable(spark, lake.path("gold", "daily_sales_summary")).read()
    assert sorted(str(r.sale_date) for r in days.collect()) == ["2024-03-01", "2024-03-05", "2024-04-02"]
    assert run(spark, lake) == []                                # nothing new
    assert [(r.upto, r.accepted, r.rejected) for r in daily.runs(spark, lake).orderBy("upto").collect()] == [(0, 4, 1), (1, 3, 0)]


def test_a_run_that_died_leaves_no_stale_day(spark, lake, monkeypatch):
    send(spark, lake, tx(1, "2024-03-01"), tx(2, "2024-03-02"), tx(5, "2024-03-02", quantity=0))
    run(spark, lake)
    send(spark, lake, tx(1, "2024-03-07", when=2), tx(9, "2024-03-07", quantity=-1, when=2))   # leaves its day empty
    whole = daily.update_gold
    monkeypatch.setattr(daily, "update_gold", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run(spark, lake)
    monkeypatch.setattr(daily, "update_gold", whole)
    send(spark, lake, tx(7, "2024-03-08", when=3))
    assert run(spark, lake) == ["p2024-03-01", "p2024-03-07"]     # the run that died, as it was
    check(spark, lake)
    assert run(spark, lake) == ["p2024-03-08"]
    check(spark, lake)
    assert VersionedTable(spark, lake.path("quarantine", "transactions")).read().count() == 2


def test_a_stored_batch_is_not_written_again(spark, lake, monkeypatch):
    """The verdict is stored by then, so silver's merge reads its rows from there; what gold merges is worked out once."""
    from silverlode.operators import partitioned

    staged = []

    class Noted(partitioned.Stage):
        def __init__(self, df, *args, **more):
            staged.append(df.columns)
            super().__init__(df, *args, **more)

    monkeypatch.setattr(partitioned, "Stage", Noted)
    send(spark, lake, tx(1, "2024-03-01"), tx(2, "2024-03-02"))
    run(spark, lake)
    send(spark, lake, tx(1, "2024-03-02", amount=20.0), tx(3, "2024-03-05"))
    assert run(spark, lake) == ["p2024-03-01", "p2024-03-02", "p2024-03-05"]
    silver = daily.silver_days(spark, lake).read()
    assert sorted((r.transaction_id, str(r.transaction_timestamp)[:10], r.final_amount) for r in silver.collect()) == [
        ("T1", "2024-03-02", 20.0), ("T2", "2024-03-02", 10.0), ("T3", "2024-03-05", 10.0)]
    assert len(staged) == 4 and not any("transaction_id" in columns for columns in staged)
