import hashlib
import re

import pytest
from pyspark.sql import functions as F

from silverlode.llm.decontamination import contamination, drop_contaminated, find_overlaps

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        w = words(text)
        for g in {tuple(w[i:i + 10]) for i in range(len(w) - 9)} if len(w) >= 10 else ({tuple(w)} if w else ()):
            windows.setdefault(g, set()).add(str(item_id))
    sizes = {len(g) for g in windows}
    out = []
    for doc_id, text in docs:
        w, hit, got = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (g := tuple(w[i:i + size])) in windows:
                    hit.update(range(i, i + size))
                    got |= windows[g]
        out.append((doc_id, len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


def pairs(df, key):
    return [(r[0], r[1]) for r in df.select(key, "text").collect()]


def test_against_brute_force(small):
    docs, items = small("documents", "/root/testdata/sf0.01"), small("benchmark", "/root/testdata/sf0.01")
    want = brute(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert rows(contamination(docs, items)) == want
    assert any(r[5] for r in want)


def test_blocks_agree_and_odd_rows(spark, odd_docs):
    line = "the quick brown fox jumps over a lazy dog and runs far away from here today"
    items = spark.createDataFrame(
        [(1, line), (2, "ONE two"), (3, None), (4, ""), (5, line), (6, "dog " + line[4:40]), (7, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 x")],
        "item_id long, text string")
    want = brute(pairs(odd_docs, "doc_id"), pairs(items, "item_id"))
    assert rows(contamination(odd_docs, items)) == want
    assert rows(contamination(odd_docs, items, block_words=8)) == want


def test_longest_match_and_removal(spark, odd_docs, empty):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l m"), (2, "z")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "q q a b c d e f g h i j k q"), (2, "z z"), (3, "y")], "doc_id long, text string")
    got = {r.doc_id: (r.longest, r.longest_at, r.longest_item) for r in find_overlaps(docs, items).collect()}
    assert got == {1: (11, 2, "1"), 2: (1, 0, "2"), 3: (0, None, None)}
    assert [r.doc_id for r in drop_contaminated(docs, items).collect()] == [3]
    assert contamination(empty, items).count() == 0
    none = items.filter("false")
    assert contamination(odd_docs, none).filter("contaminated").count() == 0
    assert drop_contaminated(odd_docs, none).columns == odd_docs.columns
    assert contamination(odd_docs, none).filter(F.col("doc_id").isNull()).count() == 1


def test_items_without_an_id(spark):
    items = spark.createDataFrame([(None, "a b c d e f g h i j k"), (None, "p q"), (3, "x y z"), (3, "y z x"), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "A b c d e f g h i j"), (2, "p q, x y z, y z x a b c d e f g h i j k"), (3, "x y z"), (4, "p")], "doc_id long, text string")
    sha = [hashlib.sha256(x).hexdigest() for x in (b"", b"3")]
    want = [(1, 10, 10, 1, sha[0], True), (2, 19, 19, 2, sha[1], True), (3, 3, 3, 1, sha[1], True), (4, 1, 0, 0, sha[0], False)]
    for words_of_block in (10**6, 1):
        assert rows(contamination(docs, items, block_words=words_of_block)) == want
        assert [r.doc_id for r in drop_contaminated(docs, items, block_words=words_of_block).collect()] == [4]
        got = {r.doc_id: (r.longest, r["items"]) for r in find_overlaps(docs, items, block_words=words_of_block).collect()}
        assert got == {1: (10, [None]), 2: (11, ["3", None]), 3: (3, ["3"]), 4: (0, [])}


def test_items_without_an_id_as_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from silverlode.llm.queries import SQL
    items = [(None, "a b c d e f g h i j k"), (None, "p q"), (3, "x y z")]
    docs = [(1, "A b c d e f g h i j"), (2, "p q, x y z"), (3, "x y z"), (4, "p")]
    con = duckdb.connect()
    for name, key, rows_ in (("benchmark", "item_id", items), ("documents", "doc_id", docs)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows_)
    want = sorted(con.execute(SQL["op2_decontaminate"]).fetchall(), key=repr)
    assert rows(contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))) == want
