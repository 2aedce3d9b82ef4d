import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from silverlode.llm import manifest


def h(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves, fanout=3):
    """Root and the levels of each leaf's siblings, as (before, after)."""
    nodes, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = a // fanout * fanout
            paths[i].append((nodes[run:a], nodes[a + 1:run + fanout]))
        nodes = [h(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [a // fanout for a in at]
    return nodes[0], paths


def brute(docs):
    by = defaultdict(list)
    for doc_id, source, lang, n_chars, text in docs:
        leaf = h(*map(enc, (doc_id, source, lang, n_chars, text)))
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        seen = h(*map(enc, (doc_id, source, lang, n_chars, text.replace("\n", "") if hit and text is not None else text)))
        by[source].append((doc_id is not None, doc_id or 0, leaf, seen, doc_id))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([r[2] for r in sorted(by[s])]) for s in names}
    root, tops = tree([trees[s][0] for s in names]) if names else ("", [])
    out = []
    for s, top in zip(names, tops):
        for (_, _, leaf, seen, doc_id), path in zip(sorted(by[s]), trees[s][1]):
            f = seen
            for before, after in path + top:
                f = h(*before, f, *after)
            out.append((doc_id, leaf, trees[s][0], root, h(*(x for b, a in path + top for x in b + a)), f, f == root))
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_against_brute_force(spark, small, odd_docs, empty):
    docs = small("documents")
    want = brute(of(docs))
    assert rows(manifest.audit(docs)) == want and {r[6] for r in want} == {True, False}
    assert rows(manifest.audit(docs.repartition(5))) == want
    assert rows(manifest.audit(odd_docs)) == brute(of(odd_docs))
    assert manifest.audit(empty).count() == 0


def test_hot_and_many_sources(spark):
    df = spark.range(1500).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 1, F.concat(F.lit("é"), F.col("id") % 400)).alias("source"),
        F.lit(None).cast("string").alias("lang"), F.col("id").alias("n_chars"), F.concat(F.lit("a\nb"), F.col("id")).alias("text"),
        F.lit(1).alias("path"), F.lit(2).alias("key"), F.lit(3).alias("leaf"), F.lit(4).alias("_seen"))
    assert rows(manifest.audit(df)) == brute(of(df))


def test_rises_agree(spark):
    nodes = spark.range(1000).select(F.lit(0).cast("long").alias("key"), F.col("id").alias("pos"), F.lit(1000).cast("long").alias("count"),
                                     F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"))
    root, paths = tree([h(str(i)) for i in range(1000)])
    want = [("".join("".join(b + a) for b, a in p), root) for p in paths]
    for rise in (1, 2, 7):
        got, _ = manifest.climb(nodes, rise)
        assert [("".join(s.before + s.after for s in r.path), r.top) for r in got.orderBy("pos").collect()] == want


def test_any_change_shows(spark, small):
    docs = small("documents").limit(40)
    got = manifest.verify(docs, F.col("doc_id") == 7, F.concat("text", F.lit("!"))).collect()
    assert [r.doc_id for r in got if not r.verified] == [7]
