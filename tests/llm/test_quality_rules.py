import re

from silverlode.llm import quality_rules as q


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines, seen, dup = t.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    hit = {k for i, g in enumerate(grams) if count[g] > 1 for k in range(i, i + 5)}
    n = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit))
    return (*n, n[0] < 10 or 100 * n[4] > 20 * n[0])


def check(docs):
    got = {}
    for r in q.verdicts(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    for doc_id, text in [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]:
        r = got[doc_id].pop()
        assert tuple(r)[1:7] == brute(text), (doc_id, text[:200] if text else text)
        assert not (r.base_failed and r.kept)


def test_against_brute_force(spark, small, odd_docs, empty):
    check(small("documents", "/root/testdata/sf0.01"))
    check(odd_docs)
    texts = ["a b c d e " * 4, "a b c d e f a b c d e", "a b c d e", "x " * 9, "\x0b\x0c a\tb ", "a a a a a a a", "l\nl\n\n\n l\nl", "a b c d"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert q.verdicts(empty).count() == 0 and q.keep_good(empty).columns == empty.columns


def test_labels_agree(small):
    docs, labels = small("documents", "/root/testdata/sf0.1"), small("labels", "/root/testdata/sf0.1")
    rows = q.verdicts(docs).join(labels, "doc_id").select("quality", "kept", "base_failed").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len([r for r in good if not r.base_failed])
    print(sum(r.kept for r in good), len(good), sum(r.base_failed for r in good), sum(r.kept for r in bad), len(bad))
    assert sum(r.kept for r in bad) <= 0.2 * len(bad)


def test_filter_and_ledger(spark, odd_docs):
    kept = q.keep_good(odd_docs)
    assert kept.schema == odd_docs.schema
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    want = sorted((r.doc_id for r in q.verdicts(odd_docs).collect() if r.kept), key=repr)
    assert ids == want and ids
    rows = [(1, 0b1), (2, 0b101), (3, 0), (4, 0b100), (5, 0b100)]
    book = spark.createDataFrame(rows, "doc_id long, fail_bits long")
    got = {(r.policy, r.rule): (r.failed, r.failed_alone, r.kept, r.kept_without) for r in q.ablations(book, {1: 0b101}).collect()}
    assert got == {(1, "few_words"): (2, 1, 1, 2), (1, "many_symbols"): (3, 2, 1, 3)}
    assert tuple(q.ever_failed(book).first()) == (0b101, 0)
