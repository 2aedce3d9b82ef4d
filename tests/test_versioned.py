"""Versioned tables: reads as of, upserts, restore, evolution, compaction, expiry."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from silverlode.operators import VersionedTable, merge_by_key, versioned
from silverlode.operators.layout import bucket_of, interleave, zorder
from silverlode.operators.versioned import VersionNotFound, check_append, compare, compare_changed

DAY = [dt.datetime(2024, 1, d) for d in range(1, 9)]


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"))


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, value int")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_versions_and_history(spark, table):
    assert table.overwrite(kv(spark, ("oak", 41), ("elm", 17)), now=DAY[0]) == 0
    assert table.append(kv(spark, ("fir", 8)), now=DAY[1]) == 1
    assert table.read(0).count() == 2
    assert table.read(1).count() == table.read().count() == 3
    assert [(r.version, r.operation, r.row_count) for r in table.history().collect()] == [
        (1, "APPEND", 1), (0, "OVERWRITE", 2)]


def test_time_travel_by_time(spark, table):
    table.append(kv(spark, ("1", 1)), now=DAY[0])
    table.append(kv(spark, ("2", 2)), now=DAY[2])
    assert table.read_at(DAY[1]).count() == 1
    assert table.read_at(DAY[2]).count() == 2
    with pytest.raises(VersionNotFound):
        table.read_at(dt.datetime(2023, 1, 1))
    with pytest.raises(VersionNotFound):
        table.read(7)


def test_a_version_does_not_change_with_later_commits(spark, table):
    table.upsert(kv(spark, ("1", 1), ("2", 2)), ["id"], now=DAY[0])
    table.upsert(kv(spark, ("1", 9)), ["id"], now=DAY[1])
    before = rows(table.read(1))
    table.append(kv(spark, ("7", 7)), now=DAY[2])
    table.upsert(kv(spark, ("2", 0), ("7", 8)), ["id"], now=DAY[3])
    table.overwrite(kv(spark, ("x", 0)), now=DAY[4])
    assert rows(table.read(1)) == before == [("1", 9), ("2", 2)]
    assert rows(table.read(3)) == [("1", 9), ("2", 0), ("7", 8)]
    assert rows(table.read()) == [("x", 0)]


def test_upsert(spark, table):
    table.upsert(kv(spark, ("elm", 17), ("oak", 41)), ["id"])
    source = kv(spark, ("fir", 8), ("oak", 44))
    table.upsert(source, ["id"])
    expected = [("elm", 17), ("fir", 8), ("oak", 44)]
    assert rows(table.read()) == expected
    table.upsert(source, ["id"])                     # again: no change
    assert rows(table.read()) == expected
    assert rows(merge_by_key(kv(spark, ("elm", 17), ("oak", 41)), source, ["id"])) == expected


def test_upsert_null_keys_are_added_and_double_keys_refused(spark, table):
    table.upsert(kv(spark, (None, 1), ("1", 1)), ["id"])
    table.upsert(kv(spark, (None, 2), ("1", 2)), ["id"])
    assert rows(table.read()) == [("1", 2), (None, 1), (None, 2)]
    with pytest.raises(ValueError):
        table.upsert(kv(spark, ("1", 3), ("1", 4)), ["id"])
    merged = merge_by_key(kv(spark, (None, 1)), kv(spark, (None, 2)), ["id"])
    assert rows(merged) == [(None, 1), (None, 2)]


def test_upsert_on_two_keys_matches_plain_merge(spark, table):
    base = spark.range(200).selectExpr("id % 20 as a", "id div 20 as b", "id as v")
    batches = [spark.range(0, 60, 1 + i).selectExpr("id % 20 as a", "id div 15 as b", f"id + {1000 * i} as v")
               .dropDuplicates(["a", "b"]) for i in range(1, 4)]
    table.upsert(base, ["a", "b"])
    expected = base
    for b in batches:
        kept = spark.createDataFrame(b.collect(), b.schema)
        table.upsert(kept, ["a", "b"])
        expected = merge_by_key(expected, kept, ["a", "b"])
    assert rows(table.read().select("a", "b", "v")) == rows(expected.select("a", "b", "v"))


def test_rows_of_the_last_upsert_are_not_looked_up(spark, table, monkeypatch):
    """Nothing can have replaced them: only what came before is joined to the upserted keys."""
    table.upsert(kv(spark, ("a", 1), ("b", 1)), ["id"])
    table.upsert(kv(spark, ("b", 2), ("c", 2), (None, 2)), ["id"])
    table.upsert(kv(spark, ("c", 3), ("d", 3), (None, 3)), ["id"])
    table.append(kv(spark, ("d", 4)))
    looked_up, plain = [], versioned.resolve_upserts
    monkeypatch.setattr(versioned, "resolve_upserts", lambda rows, *a: looked_up.append(rows) or plain(rows, *a))
    now = [("a", 1), ("b", 2), ("c", 3), ("d", 3), ("d", 4), (None, 2), (None, 3)]
    assert rows(table.read()) == now
    assert rows(looked_up[0].select("id", "value")) == [("a", 1), ("b", 1), ("b", 2), ("c", 2), (None, 2)]
    assert rows(table.read_since(1, 3)) == [("c", 3), ("d", 3), ("d", 4), (None, 3)] and len(looked_up) == 1
    table.compact()
    assert rows(table.read()) == now


def test_restore_copies_nothing_and_keeps_history(spark, table):
    table.upsert(kv(spark, ("1", 1), ("2", 2)), ["id"])
    table.upsert(kv(spark, ("1", 9)), ["id"])
    assert table.restore(0) == 2
    assert rows(table.read()) == rows(table.read(0)) == [("1", 1), ("2", 2)]
    assert rows(table.read(1)) == [("1", 9), ("2", 2)]
    table.upsert(kv(spark, ("2", 5)), ["id"])         # life goes on after a restore
    assert rows(table.read()) == [("1", 1), ("2", 5)]
    table.restore(2)
    assert rows(table.read()) == [("1", 1), ("2", 2)]


def test_schema_evolution(spark, table):
    table.append(kv(spark, ("1", 1), ("2", 2)))
    table.add_columns({"new_col": "default", "score": 0, "value": 77})
    now = table.read()
    assert now.columns == ["id", "value", "new_col", "score"]
    assert rows(now) == [("1", 1, "default", 0), ("2", 2, "default", 0)]
    table.append(spark.createDataFrame([("3", True)], "id string, flag boolean"))
    assert rows(table.read().where("id = '3'")) == [("3", None, None, None, True)]
    assert table.read(0).columns == ["id", "value"]
    with pytest.raises(TypeError):
        table.append(spark.createDataFrame([(5,)], "id int"))


def test_added_columns_write_no_rows(spark, table):
    table.append(kv(spark, ("1", 1), ("2", 2)))
    before = table.read().select(F.col("_metadata.file_path")).distinct().count()
    values = {"a": 5, "big": 1 << 40, "b": True, "s": "it's a \\ sign", "x": 0.25, "m": decimal.Decimal("1.50"),
              "d": dt.date(2024, 1, 2), "t": dt.datetime(2024, 1, 2, 3, 4, 5)}
    added = table.add_columns(values)
    assert table.commit_of(added).directory is None and table.commit_of(added).row_count == 0
    assert table.read().select(F.col("_metadata.file_path")).distinct().count() == before
    assert [r.asDict() for r in table.read().orderBy("id").select(*values).collect()] == [values, values]
    assert table.read().where("a = 5 and s like 'it%'").count() == 2 and table.read().where("a is null").count() == 0
    assert table.changes(after=0).count() == 0 and table.read_since(0, added) is None
    table.append(kv(spark, ("3", 3)))                  # without the columns
    table.upsert(spark.createDataFrame([("1", 9, 6)], "id string, value int, a int"), ["id"])
    wanted = [("1", 9, 6, None), ("2", 2, 5, True), ("3", 3, None, None)]
    assert rows(table.read().select("id", "value", "a", "b")) == wanted
    table.compact()                                    # now the values are in the files
    assert rows(table.read().select("id", "value", "a", "b")) == wanted
    assert all(not f.metadata for f in table.schema_of(table.latest_version()))
    table.restore(0)
    assert table.read().columns == ["id", "value"]
    table.add_columns({"a": 11})
    assert rows(table.read()) == [("1", 1, 11), ("2", 2, 11)]
    with pytest.raises(TypeError):
        table.add_columns({"set": {1}})


def test_failed_attempt_is_invisible(spark, table):
    table.append(kv(spark, ("1", 1)))
    kv(spark, ("9", 9)).write.parquet(table._directory("_commit=1-deadbeef"))
    assert rows(table.read()) == [("1", 1)]
    table.append(kv(spark, ("2", 2)))
    assert rows(table.read()) == [("1", 1), ("2", 2)]


def test_tables_without_success_markers(spark, table):
    option = "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs"
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set(option.removeprefix("spark.hadoop."), "false")
    try:
        assert [table.append(kv(spark, (str(i), i))) for i in range(3)] == [0, 1, 2]
        assert table.read().count() == 3 and table.read(1).count() == 2
    finally:
        hadoop.unset(option.removeprefix("spark.hadoop."))


def test_only_live_commits_reach_the_driver(spark, table):
    for i in range(4):
        table.append(kv(spark, (str(i), i)))
    table.compact()
    table.append(kv(spark, ("9", 9)))
    state = table._at(None)
    assert [c.version for c in table._live(state)] == [4, 5] and state.struct.names == ["id", "value"]
    assert [r.schema is None for r in table.log().orderBy("version").collect()] == [False, True, True, True, True, True]


def test_upserts_on_other_keys_are_refused_until_folded(spark, table):
    def xy(*r):
        return spark.createDataFrame(list(r), "x int, y int, v string")
    table.upsert(xy((1, 10, "a"), (2, 20, "b")), ["x"])
    table.upsert(xy((1, 99, "a2")), ["x"])
    with pytest.raises(ValueError):
        table.upsert(xy((3, 20, "c")), ["y"])
    table.compact()
    table.upsert(xy((3, 20, "c")), ["y"])
    assert rows(table.read()) == [(1, 99, "a2"), (3, 20, "c")]


def test_replayed_batch_is_skipped(spark, table):
    for _ in range(2):
        table.append(kv(spark, ("1", 1)), writer="w", batch=0)
    table.append(kv(spark, ("2", 2)), writer="w", batch=1)
    table.append(kv(spark, ("3", 3)), writer="other", batch=0)
    assert table.read().count() == 3


@pytest.mark.parametrize("zorder_by", [None, ["value", "id"]])
def test_compaction_keeps_the_rows(spark, table, zorder_by):
    for i in range(5):
        table.append(kv(spark, *[(str(k), k * i) for k in range(20)]).repartition(4))
    files = len(table.read().inputFiles())
    before = rows(table.read())
    table.compact(zorder_by=zorder_by)
    assert rows(table.read()) == before
    assert len(table.read().inputFiles()) < files


def test_compaction_of_partitioned_upserts(spark, table):
    def part(*r):
        return spark.createDataFrame(list(r), "id string, p string, v int")
    table.upsert(part(("1", "a", 1), ("2", None, 2)), ["id"], partition_by=["p"])
    table.upsert(part(("1", "b", 9), ("3", "12", 3)), ["id"])
    before = rows(table.read())
    assert before == [("1", "b", 9), ("2", None, 2), ("3", "12", 3)]
    table.compact()
    assert rows(table.read()) == before


def test_expiry_frees_what_no_kept_version_needs(spark, table):
    table.append(kv(spark, ("1", 1)), now=DAY[0])
    table.append(kv(spark, ("2", 2)), now=DAY[1])
    table.compact(now=DAY[2])
    table.restore(1, now=DAY[3])                       # points back behind the horizon
    table.overwrite(kv(spark, ("z", 0)), now=DAY[4])
    assert table.expire(before=DAY[3]) == 3
    for gone in (0, 1, 2):
        with pytest.raises(VersionNotFound):
            table.read(gone)
    assert rows(table.read(3)) == [("1", 1), ("2", 2)]
    assert rows(table.read()) == [("z", 0)]
    assert table.expire(before=DAY[4]) == 4
    assert rows(table.read()) == [("z", 0)]
    with pytest.raises(VersionNotFound):
        table.read(3)
    from silverlode.session import list_names
    assert list_names(spark, f"{table.path}/data") == [table.commit_of(4).directory]


def test_expiry_keeps_what_a_restore_and_a_writer_need(spark, table):
    table.append(kv(spark, ("1", 1)), now=DAY[0], writer="w", batch=5)
    table.overwrite(kv(spark, ("x", 1)), now=DAY[1])
    table.restore(0, now=DAY[2])
    table.restore(2, now=DAY[3])                       # a restore of a restore
    table.append(kv(spark, ("2", 2)), now=DAY[4])
    kv(spark, ("9", 9)).write.parquet(table._directory("_commit=5-deadbeef"))     # failed attempt
    assert table.expire(before=DAY[4]) == 4
    assert rows(table.read()) == [("1", 1), ("2", 2)]
    from silverlode.session import list_names
    assert len(list_names(spark, f"{table.path}/data")) == 2
    table.append(kv(spark, ("1", 1)), writer="w", batch=5)      # still known as done
    assert table.latest_version() == 4
    table.overwrite(kv(spark, ("z", 0)), now=DAY[6])
    assert table.expire(before=DAY[6]) == 5
    table.append(kv(spark, ("1", 1)), writer="w", batch=5)
    assert rows(table.read()) == [("z", 0)]


def test_compare_and_append_check(spark, table):
    table.append(kv(spark, ("oak", 41), ("elm", 17), ("ash", None)))
    table.append(kv(spark, ("fir", 8), ("yew", 23)))
    assert check_append(table, 0, 1).first().asDict() == {
        "rows_before": 3, "rows_written": 2, "rows_after": 5, "consistent": True}
    other = kv(spark, ("elm", 17), ("ash", 30), ("fir", 8), ("box", 61))
    assert compare(table.read(), other, ["id"]).first().asDict() == {
        "rows_before": 5, "rows_after": 4, "added": 1, "removed": 2, "changed": 1, "unchanged": 2}


def test_compare_pairs_repeated_and_missing_keys(spark):
    a = kv(spark, (None, 1), (None, 2), (None, 3), ("1", 1), ("1", 1))
    b = kv(spark, (None, 1), (None, 9), ("1", 1), ("2", 2))
    assert compare(a, a, ["id"]).first().asDict() == {
        "rows_before": 5, "rows_after": 5, "added": 0, "removed": 0, "changed": 0, "unchanged": 5}
    assert compare(a, b, ["id"]).first().asDict() == {
        "rows_before": 5, "rows_after": 4, "added": 1, "removed": 2, "changed": 1, "unchanged": 2}
    assert compare(a.limit(0), a.limit(0), ["id"]).first().rows_before == 0


def test_compare_changed_agrees_with_compare(spark):
    a = kv(spark, (None, 1), (None, 2), (None, 3), ("1", 1), ("1", 1), ("2", None), *[(f"k{i}", i) for i in range(300)])
    b = kv(spark, (None, 1), (None, 9), ("1", 1), ("2", 2), *[(f"k{i}", i if i % 100 else -1) for i in range(300)])
    for left, right in ((a, b), (b, a), (a, a), (a, b.limit(0)), (a.limit(0), a.limit(0))):
        whole = compare(left, right, ["id"]).first().asDict()
        for buckets in (1, 7, 4096):
            found = compare_changed(left, right, ["id"], buckets).first().asDict()
            held, compared = found.pop("buckets_held"), found.pop("buckets_compared")
            assert found == whole and compared <= held <= buckets
            assert compared == 0 or left is not right
    # a value and a missing one change places; equal rows come an even number of times
    a = spark.createDataFrame([("x", None, "v"), ("y", "w", "w"), ("y", "w", "w")], "id string, p string, q string")
    b = spark.createDataFrame([("x", "v", None), ("y", "u", "u"), ("y", "u", "u")], "id string, p string, q string")
    assert compare_changed(a, b, ["id"]).first().changed == 3


def test_changes(spark, table):
    table.append(kv(spark, ("oak", 41)))
    table.append(kv(spark, ("elm", 17)))
    table.append(kv(spark, ("fir", 8)))
    assert rows(table.changes(after=0)) == [("elm", 17, 1, "append"), ("fir", 8, 2, "append")]
    assert rows(table.changes(after=0, upto=1)) == [("elm", 17, 1, "append")]
    assert table.changes(after=2).count() == 0
    table.compact()                                    # changes no row
    assert table.changes(after=2).count() == 0
    table.restore(0)
    assert rows(table.changes(after=2)) == [("elm", 17, 4, "delete"), ("fir", 8, 4, "delete")]
    table.overwrite(kv(spark, ("oak", 41), ("yew", 5)))
    assert rows(table.changes(after=4)) == [("yew", 5, 5, "insert")]


def test_compaction_keeps_commit_numbers(spark, table):
    table.append(kv(spark, ("oak", 41)))
    table.append(kv(spark, ("elm", 17)))
    table.compact()
    table.append(kv(spark, ("fir", 8)))
    table.compact()
    assert rows(table.read_since(0, 4)) == [("elm", 17), ("fir", 8)]
    assert rows(table.read_since(1, 4)) == [("fir", 8)] and rows(table.read_since(3, 4)) == []
    assert table.read().columns == ["id", "value"]


def test_interleave_matches_bit_by_bit(spark):
    df = spark.range(16).selectExpr("id % 4 as a", "id div 4 as b")
    for r in df.select("a", "b", interleave([F.col("a"), F.col("b")], 2).alias("z")).collect():
        want = sum(((r.a >> j) & 1) << (2 * j) | ((r.b >> j) & 1) << (2 * j + 1) for j in range(2))
        assert r.z == want


def test_bucket_of(spark):
    cuts = [1.0, 2.5, 4.0]
    df = spark.createDataFrame([(x,) for x in (None, 0.0, 1.0, 1.5, 2.5, 3.0, 4.0, 9.0)], "x double")
    got = [r.b for r in df.select(bucket_of(F.col("x"), cuts).alias("b")).collect()]
    assert got == [0, 0, 0, 1, 1, 2, 2, 3]


def test_zorder_narrows_both_columns_and_cuts_hot_values(spark):
    n = 40000
    df = spark.range(n, numPartitions=8).selectExpr("id % 200 as a", "(id * 7919) % 211 as b", "cast(id as string) as s")
    out = zorder(df, ["a", "b"], partitions=16)
    assert out.exceptAll(df).count() == 0 and out.count() == n
    spans = out.groupBy(F.spark_partition_id()).agg(
        (F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")).agg(
        F.avg("a").alias("a"), F.avg("b").alias("b")).first()
    assert spans.a < 120 and spans.b < 130
    same = spark.range(8000, numPartitions=8).selectExpr("1 as a", "2 as b")
    sizes = [r["count"] for r in zorder(same, ["a", "b"], partitions=4).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) <= 4000


def test_ids_with_a_common_start_are_clustered(spark):
    n = 60000
    df = spark.range(n, numPartitions=6).selectExpr("format_string('TXN_%08d', (id * 7919) % 60000) as k", "id % 97 as v")
    for columns in (["k"], ["k", "v"]):
        out = zorder(df, columns, partitions=16)
        assert out.count() == n
        spans = out.groupBy(F.spark_partition_id()).agg(F.min("k").alias("a"), F.max("k").alias("b")).collect()
        cover = [sum(r.a <= f"TXN_{k:08d}" <= r.b for r in spans) for k in range(0, n, 1111)]
        assert sum(cover) / len(cover) <= (1.2 if len(columns) == 1 else 8)


def test_compaction_of_partitioned_tables_makes_few_files(spark, table):
    df = spark.range(4000, numPartitions=8).selectExpr("id", "id % 20 as p")
    table.append(df, partition_by=["p"])
    before = len(table.read().inputFiles())
    table.compact()
    assert len(table.read().inputFiles()) <= 20 < before
    table.compact(zorder_by=["id"])
    assert len(table.read().inputFiles()) <= 20 and table.read().count() == 4000


def test_changes_of_a_restore_read_only_what_differs(spark, tmp_path):
    """Commits that both sides have cancel out, copies of rows included; nothing is compared."""
    table = VersionedTable(spark, f"{tmp_path}/t")
    for part in ([(1, "a"), (1, "a")], [(1, "a"), (2, "b")], [(3, None)]):
        table.append(spark.createDataFrame(part, "k int, v string"))
    table.compact()
    table.restore(0)
    gone = table.changes(after=2)
    plan = gone._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    assert sorted((r.k, r.v, r._version, r._change) for r in gone.collect()) == [
        (1, "a", 4, "delete"), (2, "b", 4, "delete"), (3, None, 4, "delete")]
    table.append(spark.createDataFrame([(2, "b"), (4, "d")], "k int, v string"))
    table.restore(1)                     # takes the last append away and brings the second one back
    assert sorted((r.k, r.v, r._change) for r in table.changes(after=5).collect()) == [(1, "a", "insert"), (4, "d", "delete")]


def test_changes_of_a_restore_with_upserts_or_added_columns(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    table.append(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    table.add_columns({"n": 7})
    table.restore(0)
    both = sorted((r.k, r.v, r.n, r._change) for r in table.changes(after=1).collect() if r.k == 1) if "n" in table.changes(after=1).columns else None
    assert both in (None, [(1, "a", 7, "delete"), (1, "a", None, "insert")])
    table.upsert(spark.createDataFrame([(2, "z")], "k int, v string"), ["k"])
    table.restore(2)
    assert sorted((r.k, r.v, r._change) for r in table.changes(after=3).collect()) == [(2, "b", "insert"), (2, "z", "delete")]
