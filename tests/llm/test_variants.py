import random
import re
import zlib
from collections import Counter

from silverlode.llm import variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(docs, damage=199, min_count=5):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= min_count}


def brute_forms(n):
    form, count = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        count[w] = len(others)
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        end = w
        while form[end]:
            end = form[end]
        out.append((w, form[w], end, n[w], count[w], n[form[w]] if form[w] else None))
    return sorted(out)


def rows(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_against_brute_force(spark, small, odd_docs, empty):
    docs = small("documents")
    want = brute_forms(brute_words(of(docs)))
    assert rows(variants.variants(docs)) == want and sum(r[1] is not None for r in want) > 5
    assert rows(variants.variants(odd_docs)) == brute_forms(brute_words(of(odd_docs)))
    assert variants.variants(empty).count() == 0


def test_pairs_of_random_words(spark):
    rng = random.Random(5)
    words = set()
    while len(words) < 900:                     # short alphabets: anagrams, repeats and large groups
        words.add("".join(rng.choice("abéÿ" if rng.random() < 0.3 else "aabé") for _ in range(rng.randrange(6, 10))))
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = [(r.word, r.other) for r in variants.near_pairs(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if near(a, b)}


def test_forms_lead_to_roots(spark):
    chain = {"absolute": 3125, "absolut": 625, "absolt": 125, "abselute": 25, "absalt": 25, "elephant": 9, "elephand": 7}
    docs = spark.createDataFrame([(i, " ".join([w] * c)) for i, (w, c) in enumerate(chain.items())], "doc_id long, text string")
    got = {r[0]: r[1:] for r in rows(variants.variants(docs, damage=10**12))}
    assert got["absalt"] == ("absolt", "absolute", 25, 1, 125) and got["absolute"] == (None, "absolute", 3125, 2, None)
    assert got["elephand"] == (None, "elephand", 7, 1, None)


def test_damage(spark):
    docs = spark.createDataFrame([(1, "Grüßend Grüßend ABCDEFG x abcdefg"), (None, "abcdefg")], "doc_id long, text string")
    got = {r.word: r.n for r in variants.vocabulary(docs, damage=3, min_count=1).collect()}
    assert got == brute_words(of(docs), damage=3, min_count=1)
    got = {r.word: r.n for r in variants.vocabulary(docs, damage=1, min_count=1).collect()}
    assert got == brute_words(of(docs), damage=1, min_count=1)


def test_signatures_are_not_broadcast(spark, tmp_path):
    """Spark sizes them by the words they are made of, a twentieth of their rows."""
    spark.createDataFrame([("absolute", 9), ("absolut", 8)], "word string, n long").write.parquet(f"{tmp_path}/words")
    plan = variants.near_pairs(spark.read.parquet(f"{tmp_path}/words"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
