import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from silverlode.llm import grading


def test_held_out_grades(small):
    sf = "/root/testdata/sf0.1"
    docs, rated = small("documents", sf), grading.ratings(small("labels", sf))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = grading.fit(docs, rated.filter(~held))
    assert (np.diff(model.thresholds) > 0).all()
    got = grading.grade(docs, model).join(rated.filter(held), "doc_id")
    by = {r.grade: r for r in got.groupBy("grade").agg(F.avg(F.col("keep").cast("int")).alias("keep"), F.avg("expected_grade").alias("mean")).collect()}
    assert by[2].keep >= 0.93 and by[1].keep <= 0.2 and by[0].keep <= 0.25
    assert by[0].mean < by[1].mean < by[2].mean
    assert got.filter("p_above_1 > p_above_0 or expected_grade < 0 or expected_grade > 2").count() == 0


def test_features_are_sets_of_words():
    a, first = grading.features(pa.array(["Scum, scum! (SCUM)", None, ""]))
    one, _ = grading.features(pa.array(["scum"]))
    assert set(one) & set(a[:first[1]]) and len(first) == 4


def test_odd_rows(spark, odd_docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (8, 1, 1), (9, None, 0), (None, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    rows = grading.classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.p_above_1 <= r.p_above_0 <= 1 for r in rows)
    assert {(r.doc_id, r.grade) for r in grading.ratings(labels).collect()} == {(1, 1), (7, 1), (8, 0)}
    assert grading.classify(empty, labels).count() == 0
    none = grading.classify(odd_docs, labels.filter("false")).collect()
    assert len({r.expected_grade for r in none}) == 1


def test_the_sample_is_bounded(spark, small):
    docs = small("documents").select("doc_id", "text")
    repeated = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    rated = docs.select("doc_id", (F.col("doc_id") % 3).cast("int").alias("grade"))
    assert 0 < grading.sample(docs.unionByName(repeated), rated, 50).count() <= 50
