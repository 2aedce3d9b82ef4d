import numpy as np
from pyspark.sql import functions as F

from silverlode.llm import language


def test_held_out_accuracy(small):
    docs = small("documents", "/root/testdata/sf0.01")
    model = language.fit(docs)
    assert model.langs == ["de", "en", "es", "fr"]
    got = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    r = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert r.n > 150 and r.a >= 0.97
    assert got.filter("score < 0 or score > 1").count() == 0
    # only the text decides
    bare = language.predict(docs.select("doc_id", "text"), model).collect()
    assert {x.doc_id: x.lang_pred for x in bare} == {x.doc_id: x.lang_pred for x in got.collect()}


def test_the_held_out_fold_and_rows_without_lang_teach_nothing(small):
    docs = small("documents")
    a = language.fit(docs)
    changed = docs.withColumn("lang", F.when(language.held_out(), "xx").otherwise(F.col("lang")))
    b = language.fit(changed.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 10**6).withColumn("lang", F.lit(None).cast("string"))))
    assert a.langs == b.langs and (a.weights == b.weights).all()


def test_odd_rows(odd_docs, empty):
    rows = language.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (2, 3, 4))
    assert by[None].held_out is False and by[1].lang_pred in {"en", "de", "fr", "xx"}
    assert language.identify(empty).count() == 0
    untaught = language.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in untaught} == {"und"}


def test_the_sample_is_bounded(spark, small):
    docs = small("documents").select("doc_id", "text", "lang")
    one = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("one text").alias("text"), F.lit("en").alias("lang"))
    many = spark.range(600).select((F.col("id") + 1000).alias("doc_id"), F.lit("dirt").alias("text"), F.concat(F.lit("l"), "id").alias("lang"))
    for rows in (60, 300):
        assert 0 < language.sample(docs.unionByName(one).unionByName(many), rows).count() <= rows
    assert language.identify(docs.limit(5).unionByName(many)).count() == 605


def test_weights_against_a_dense_solution(small):
    """The Nystroem features have the landmark kernel as their Gram matrix, and the scores those of a
    weighted kernel ridge solved directly in the space of the landmarks."""
    docs = small("documents")
    rows = sorted(language.sample(docs, 400).mapInArrow(language._bits, "lang string, h long, bits binary").collect())
    m = language.fit(docs, 400, landmarks=40)
    x = np.array([np.unpackbits(np.frombuffer(r.bits, np.uint8)) for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.array([m.langs.index(r.lang) for r in rows])
    z = m.landmarks.astype(float)
    k, kz = x @ z.T, z @ z.T
    weight = len(y) / (len(m.langs) * np.bincount(y)[y])
    target = np.where(y[:, None] == np.arange(len(m.langs)), 1.0, -1.0)
    # minimise |W^(1/2)(K a - T)|^2 + ridge a' Kz a
    a = np.linalg.lstsq(k.T @ (weight[:, None] * k) + language.RIDGE * len(y) / 10 * kz, k.T @ (weight[:, None] * target), rcond=None)[0]
    assert np.abs(k @ a - k @ m.weights).max() < 1e-2
