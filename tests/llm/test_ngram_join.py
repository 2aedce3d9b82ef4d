import random
import re

import numpy as np

from silverlode.llm import ngram_join as nj
from silverlode.llm.components import connected


def sets_of(docs, size=5):
    out = []
    for i, t in docs:
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append((i, {tuple(w[a:a + size]) for a in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())))
    return out


def brute(docs, size=5, percent=75):
    sets = sets_of(docs, size)
    up = {i: i for i, _ in sets if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    by = {}
    for k, (i, s) in enumerate(sets):
        for g in s if i is not None else ():
            by.setdefault(g, []).append(k)
    seen = {(a, b) for ks in by.values() for x, a in enumerate(ks) for b in ks[x + 1:]}
    for a, b in seen:
        (i, s), (j, t) = sets[a], sets[b]
        if 100 * len(s & t) >= percent * len(s | t):
            x, y = sorted((root(i), root(j)))
            up[y] = x
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    up = list(range(2000))
    for _ in range(100):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    got = connected(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == {x: up[x] for a, b in edges if a != b for x in (a, b)}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tree_overlaps():
    rng = np.random.default_rng(4)
    for _ in range(200):
        base = np.sort(rng.choice(400, 200, replace=False)).astype(np.uint64)
        sets = []
        for _ in range(12):
            s = np.concatenate((base[rng.random(200) > rng.choice([0.02, 0.1, 0.3])], rng.choice(np.arange(400, 900), rng.integers(0, 30), replace=False).astype(np.uint64)))
            sets.append(np.sort(s))
        probe = sets[0]
        want = [i for i, s in enumerate(sets) if 175 * len(np.intersect1d(s, probe)) >= 75 * (len(s) + len(probe))]
        assert sorted(nj.tree_overlaps(probe, len(probe), sets, [len(s) for s in sets])) == want


def test_against_brute_force(spark, small, odd_docs, empty):
    docs = small("documents", "/root/testdata/sf0.01")
    want = brute(pairs(docs))
    assert rows(nj.near_duplicates(docs)) == want
    assert sum(r[0] != r[2] for r in want) > 20
    assert rows(nj.near_duplicates(odd_docs)) == brute(pairs(odd_docs))
    assert nj.near_duplicates(empty).count() == 0
    kept = nj.keep_one(odd_docs)
    assert kept.schema == odd_docs.schema
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == sorted({c for _, _, c in brute(pairs(odd_docs)) if c is not None})


def test_chains_near_the_threshold(spark):
    """Chains of texts in which neighbours are linked and others are not."""
    rng, docs, k = random.Random(9), [], 0
    for chain in range(12):
        w = [f"c{chain}w{i}" for i in range(rng.choice((6, 12, 40, 90)))]
        for _ in range(14):
            docs.append((k, " ".join(w)))
            k += 1
            for _ in range(rng.choice((1, 1, 2))):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            if rng.random() < 0.4:
                w = w + [f"e{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 4))]
    docs += [(k + i, "common words in many of the texts here " * 2 + f"x{i % 7} y{i % 3} z") for i in range(60)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(nj.near_duplicates(df)) == brute(docs)


def test_keep_one_of_repeated_rows(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [(1, line, "a"), (1, line, "a"), (1, line, "b"), (2, line, "c"), (3, None, "d"), (3, None, "d"), (3, "", "e"), (None, line, "f"),
            (None, line, "f"), (4, "another text of its own that nobody shares at all", "g"), (5, line + " eleven", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id0 string").repartition(4)
    kept = sorted(((r.doc_id, r.text, r._id0) for r in nj.keep_one(docs).collect()), key=repr)
    assert [r for r in kept if r[0] == 1] in ([(1, line, "a")], [(1, line, "b")])
    assert sorted((r for r in kept if r[0] != 1), key=repr) == sorted((r for r in rows if r[0] in (3, 4, None)), key=repr)
    again = sorted(((r.doc_id, r.text, r._id0) for r in nj.keep_one(docs.repartition(2)).collect()), key=repr)
    assert again == kept
