"""Streams that really run: one file per micro-batch, take what is there, stop."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from silverlode.operators import VersionedTable
from silverlode.plans import ingest
from silverlode.sources import Layers, bus_stream, file_stream
from silverlode.streaming import decode_events, enrich_events, ingest_stream, silver_stream, window_totals, windowed_stream
from silverlode.streaming.events import split_malformed

T = dt.datetime


def event(i, clock, amount=10.0, status="completed", **more):
    return json.dumps({
        "transaction_id": f"T{i}", "customer_id": "C1", "product_id": "P1",
        "transaction_date": f"2024-01-01 {clock}", "quantity": 1, "unit_price": amount,
        "total_amount": amount, "discount": 0.0, "final_amount": amount,
        "payment_method": "Card", "status": status, "shipping_address": "x", **more})


@pytest.fixture
def bus(spark, tmp_path):
    """Drops batches of messages as files and opens a stream over them."""
    folder, count = tmp_path / "bus", [0]
    folder.mkdir()

    class Bus:
        def send(self, *messages):
            count[0] += 1
            rows = [(None, m.encode(), T(2024, 1, 1)) for m in messages]
            (spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp")
             .coalesce(1).write.mode("append").parquet(str(folder)))

        def stream(self):
            return file_stream(spark, str(folder), max_files=1)

    return Bus()


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_decode_and_enrich(spark):
    rows = [(b"k", event(1, "10:00:00").encode(), T(2024, 1, 1)), (None, b"not json", None), (None, b"{}", None)]
    env = spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp")
    out = enrich_events(decode_events(env), T(2024, 1, 2)).collect()
    assert len(out) == 3
    first = next(r for r in out if r.transaction_id == "T1")
    assert first.kafka_key == "k" and first.source_file == "kafka_stream" and first.data_source == "kafka"
    assert first.transaction_timestamp == dt.datetime(2024, 1, 1, 10) and first.ingestion_date == dt.date(2024, 1, 2)
    assert sum(r.transaction_id is None for r in out) == 2
    good, bad = split_malformed(env)
    assert good.count() == 2 and bad.first().value_text == "not json"


def test_ingest_keeps_late_rows_and_runs_once(spark, bus, tmp_path):
    table, ck = str(tmp_path / "t"), str(tmp_path / "ck")
    bus.send(event(1, "10:30:00"))
    bus.send(event(2, "09:00:00"))
    run(ingest_stream(bus.stream(), table, ck, every=None))
    bus.send(event(3, "09:00:00"), "garbage")
    run(ingest_stream(bus.stream(), table, ck, every=None))
    run(ingest_stream(bus.stream(), table, ck, every=None))          # nothing new
    rows = VersionedTable(spark, table).read()
    assert sorted(r.transaction_id or "" for r in rows.collect()) == ["", "T1", "T2", "T3"]
    # the driver died before it noted the last batch as done: the batch comes again
    commits = tmp_path / "ck" / "commits"
    last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink()
    run(ingest_stream(bus.stream(), table, ck, every=None))
    assert VersionedTable(spark, table).read().count() == 4
    # with a new checkpoint everything is new; better twice than lost
    run(ingest_stream(bus.stream(), table, str(tmp_path / "ck2"), every=None))
    assert VersionedTable(spark, table).read().count() == 8


def test_update_mode_drops_rows_behind_the_watermark(spark, bus, tmp_path):
    """A batch is filtered by the watermark the batch before it left behind."""
    table, ck = str(tmp_path / "t"), str(tmp_path / "ck")
    for i, clock in enumerate(["10:30:00", "09:00:00", "09:00:00", "09:00:00"]):
        bus.send(event(i, clock))
    run(windowed_stream(bus.stream(), table, ck, window="1 hour", every=None))
    got = {r.window_start.hour: r.transaction_count for r in VersionedTable(spark, table).read().collect()}
    assert got == {10: 1, 9: 1}


def test_update_mode_revises_open_windows(spark, bus, tmp_path):
    table, ck = str(tmp_path / "t"), str(tmp_path / "ck")
    bus.send(event(1, "10:00:10", 1.5), event(2, "10:00:20", 2.0), event(3, "10:00:30", 9.0, "pending"))
    run(windowed_stream(bus.stream(), table, ck, every=None))
    bus.send(event(4, "10:00:50", 4.0), event(5, "10:01:00", 8.0, None))
    run(windowed_stream(bus.stream(), table, ck, every=None))
    rows = {(r.window_start.minute, r.status): (r.transaction_count, r.total_revenue)
            for r in VersionedTable(spark, table).read().collect()}
    assert rows == {(0, "completed"): (3, 7.5), (0, "pending"): (1, 9.0), (1, None): (1, 8.0)}


def test_append_mode_gives_final_windows_only(spark, bus, tmp_path):
    table, ck = str(tmp_path / "t"), str(tmp_path / "ck")
    bus.send(event(1, "10:00:10"), event(2, "10:20:00"))
    run(windowed_stream(bus.stream(), table, ck, every=None, mode="append"))
    got = [r.window_start.minute for r in VersionedTable(spark, table).read().collect()]
    assert got == [0]


def test_window_totals_on_a_batch(spark):
    rows = spark.createDataFrame(
        [("1", T(2024, 1, 1, 10, 0, 0), 1.0, "A"), ("2", T(2024, 1, 1, 10, 0, 59), 2.0, "A"),
         ("3", T(2024, 1, 1, 10, 1, 0), 4.0, "A")],
        "transaction_id string, transaction_timestamp timestamp, final_amount double, status string")
    got = {r.window.start.minute: (r.transaction_count, r.total_revenue) for r in window_totals(rows).collect()}
    assert got == {0: (2, 3.0), 1: (1, 4.0)}


def test_bronze_to_silver_as_a_stream(spark, bus, tmp_path):
    lake = Layers(str(tmp_path / "lake"))
    bronze = lake.path("bronze", "transactions")
    bus.send(event(1, "10:00:00"), event(2, "10:01:00"), "garbage")
    run(ingest_stream(bus.stream(), bronze, str(tmp_path / "ck"), every=None))
    run(silver_stream(spark, bus.stream(), lake, str(tmp_path / "ck-silver"), every=None))
    assert VersionedTable(spark, lake.path("silver", "transactions")).read().count() == 2
    assert VersionedTable(spark, lake.path("quarantine", "transactions")).read().count() == 1


def test_files_and_events_share_a_bronze_table(spark, bus, tmp_path):
    lake = Layers(str(tmp_path / "lake"))
    csv = tmp_path / "t.csv"
    csv.write_text("transaction_id,customer_id,product_id,transaction_date,quantity,unit_price,total_amount,"
                   "discount,final_amount,payment_method,status,shipping_address\n"
                   "F1,C1,P1,2024-01-01 10:00:00,1,1.0,1.0,0.0,1.0,Card,completed,x\n")
    ingest(spark, str(csv), lake, "transactions")
    bus.send(event(1, "10:00:00"))
    run(ingest_stream(bus.stream(), lake.path("bronze", "transactions"), str(tmp_path / "ck"), every=None))
    rows = {r.transaction_id: r for r in VersionedTable(spark, lake.path("bronze", "transactions")).read().collect()}
    assert rows["F1"].data_source == "ecommerce" and rows["F1"].kafka_timestamp is None
    assert rows["T1"].data_source == "kafka"


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        bus_stream(spark, "nowhere:9092", "transactions").select(F.col("key"))


def test_metrics_of_batches(spark, bus, tmp_path):
    bus.send(event(1, "10:00:00"), event(2, "10:05:00"))
    bus.send(event(3, "09:00:00"), "no json")
    for _ in range(2):                          # nothing new the second time: nothing is added
        ingest_stream(bus.stream(), str(tmp_path / "t"), str(tmp_path / "ck"), every=None,
                      metrics_path=str(tmp_path / "metrics")).awaitTermination()
    rows = VersionedTable(spark, str(tmp_path / "metrics")).read().orderBy("batch_id").collect()
    assert [(r.batch_id, r.n_rows, r.n_incomplete) for r in rows] == [(0, 2, 0), (1, 2, 1)]
    assert rows[0].first_time == dt.datetime(2024, 1, 1, 10) and rows[1].last_time == dt.datetime(2024, 1, 1, 9)


def test_batches_of_several_files_are_the_same_batches(spark, sf, tmp_path, monkeypatch):
    """Each batch comes in equally many files, so each trigger takes one batch whole, whatever the size of a file."""
    from workload import catalog

    monkeypatch.setattr(catalog, "FILE_BYTES", 4096)
    bus = catalog._batched_events(spark, sf, str(tmp_path))
    counts = []
    bus.writeStream.foreachBatch(lambda df, i: counts.append(df.count())).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    files = [n for n in (tmp_path / "bus").iterdir() if n.name.endswith(".parquet")]
    assert len(files) > 6 and len(files) % 6 == 0
    monkeypatch.setattr(catalog, "FILE_BYTES", 1 << 40)
    one = []
    catalog._batched_events(spark, sf, f"{tmp_path}/one").writeStream.foreachBatch(lambda df, i: one.append(df.count())).option(
        "checkpointLocation", f"{tmp_path}/ck1").trigger(availableNow=True).start().awaitTermination()
    assert counts == one and len(one) == 6
