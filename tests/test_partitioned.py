"""Tables that change partition by partition."""

import random

import pytest
from pyspark.sql import functions as F

from silverlode.operators.partitioned import PartitionedTable


@pytest.fixture
def table(spark, tmp_path):
    return PartitionedTable(spark, str(tmp_path / "t"), F.col("day"), ["k"])


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, day int, v int")


def rows(df):
    return sorted(map(tuple, df.select("k", "day", "v").collect()), key=repr)


def files(tmp_path, part):
    return {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t" / "rows" / f"_part={part}").iterdir() if f.name.endswith(".parquet")}


def test_merge_writes_touched_partitions_only(spark, table, tmp_path):
    table.merge(frame(spark, ("a", 1, 1), ("b", 1, 2), ("c", 2, 3), ("d", 3, 4)))
    before = files(tmp_path, "p3")
    assert table.merge(frame(spark, ("b", 1, 20), ("e", 2, 5))) == ["p1", "p2"]
    assert rows(table.read()) == [("a", 1, 1), ("b", 1, 20), ("c", 2, 3), ("d", 3, 4), ("e", 2, 5)]
    assert files(tmp_path, "p3") == before and table.parts() == ["p1", "p2", "p3"]
    assert rows(table.read(["p2"])) == [("c", 2, 3), ("e", 2, 5)]


def test_rows_move_between_partitions(spark, table):
    table.merge(frame(spark, ("a", 1, 1), ("b", 2, 2)))
    assert table.merge(frame(spark, ("a", 2, 9))) == ["p1", "p2"]       # the first one is left empty
    assert rows(table.read()) == [("a", 2, 9), ("b", 2, 2)] and table.parts() == ["p2"]


def test_null_keys_null_days_new_columns_and_replay(spark, table):
    first = frame(spark, (None, None, 1), ("a", 1, 1))
    table.merge(first)
    batch = frame(spark, (None, 1, 2), ("b", None, 3)).withColumn("extra", F.lit("x"))
    table.merge(batch)
    got = sorted(map(tuple, table.read().collect()), key=repr)
    assert got == sorted([(None, None, 1, None), ("a", 1, 1, None), (None, 1, 2, "x"), ("b", None, 3, "x")], key=repr)
    keyed = frame(spark, ("a", 1, 7))
    table.merge(keyed)
    once = rows(table.read())
    table.merge(keyed)
    assert rows(table.read()) == once


def test_against_a_dictionary(spark, table):
    rng, want = random.Random(4), {}
    for _ in range(4):
        batch = {f"k{rng.randrange(40)}": (rng.randrange(6), rng.randrange(100)) for _ in range(12)}
        want |= batch
        table.merge(frame(spark, *[(k, *v) for k, v in batch.items()]))
    assert rows(table.read()) == sorted((k, *v) for k, v in want.items())


def test_a_job_that_died_is_finished(spark, table, monkeypatch):
    table.merge(frame(spark, ("a", 1, 1), ("b", 2, 2), ("c", 3, 3)))
    whole = PartitionedTable._overwrite
    monkeypatch.setattr(PartitionedTable, "_overwrite", lambda self, df: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.merge(frame(spark, ("a", 2, 9)))
    # worse: the partitions to be replaced are gone already
    from silverlode.session import remove_path
    remove_path(spark, f"{table.path}/rows/_part=p2")
    monkeypatch.setattr(PartitionedTable, "_overwrite", whole)
    assert rows(table.read()) == [("a", 2, 9), ("b", 2, 2), ("c", 3, 3)]


def test_one_that_died_earlier_never_happened(spark, table):
    table.merge(frame(spark, ("a", 1, 1)))
    frame(spark, ("zz", 1, 5)).withColumn("_part", F.lit("p1")).write.partitionBy("_part").parquet(f"{table.path}/next/rows")
    assert rows(table.read()) == [("a", 1, 1)]
    table.merge(frame(spark, ("b", 1, 2)))
    assert rows(table.read()) == [("a", 1, 1), ("b", 1, 2)]


def test_replace(spark, table):
    table.merge(frame(spark, ("a", 1, 1), ("b", 2, 2)))
    assert table.replace(frame(spark, ("x", 2, 5), ("y", 3, 6))) == ["p2", "p3"]
    assert rows(table.read()) == [("a", 1, 1), ("x", 2, 5), ("y", 3, 6)]
    assert table.replace(frame(spark).where("false")) == []
