import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from silverlode.llm import mixing


def u32(*x):
    return int(hashlib.md5(":".join(map(str, x)).encode()).hexdigest()[:8], 16)


def brute(docs, weights=(5, 2, 1), share=1.5, cap=2, block_words=mixing.BLOCK_WORDS, seed="mix"):
    rows, seen = [], Counter()
    for doc_id, source, text in docs:
        digest = hashlib.md5((text or "").encode()).hexdigest()
        seen[doc_id, source, digest] += 1
        rows.append((doc_id, source, digest, seen[doc_id, source, digest], len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(r[4] for r in rows if r[1] == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    full, level = set(), 0.0
    while len(full) < len(sources):
        level = (share * sum(size.values()) - cap * sum(size[s] for s in full)) / sum(weight[s] for s in sources if s not in full)
        over = {s for s in sources if weight[s] * level > cap * size[s]}
        if over == full:
            break
        full = over
    out = []
    for sid, s in enumerate(sources):
        target = float(cap * size[s]) if s in full else weight[s] * level
        own = [r for r in rows if r[1] == s]
        take = math.floor(target)
        epochs, rest = divmod(take, size[s]) if size[s] else (0, 0)
        n = max(1, min(sum(r[4] > 0 for r in own), math.ceil(size[s] / block_words)))
        key = lambda r: (u32(seed, "-" if r[0] is None else r[0], r[2], r[3]), r[2], -1 if r[0] is None else r[0], r[3])
        blocks = defaultdict(list)
        for r in own:
            if r[4]:
                blocks[key(r)[0] * n >> 32].append(r)
        times, plus = mixing.PRIMES[u32(seed, "times", sid, epochs) % 8], u32(seed, "plus", sid, epochs) % n
        taken, left = Counter(), rest
        for b in sorted(blocks, key=lambda b: (times * b + plus) % n):
            for r in sorted(blocks[b], key=key):
                taken[r] = min(r[4], left)
                left -= taken[r]
        out += [(r[0], r[4], size[s], target, epochs * r[4] + taken[r]) for r in own]
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "size", "source_size", "target", "taken").collect()), key=repr)


def of(df):
    return [(r.doc_id, r.source, r.text) for r in df.select("doc_id", "source", "text").collect()]


def test_against_brute_force(spark, small, odd_docs, empty):
    docs = small("documents")
    for block in (mixing.BLOCK_WORDS, 300):
        got = rows(mixing.measure(docs, block_words=block))
        assert got == brute(of(docs), block_words=block)
        assert sum(r[4] for r in got) >= 1.5 * sum(r[1] for r in got) - 20 and all(r[4] <= 2 * r[1] for r in got)
    assert rows(mixing.measure(odd_docs, block_words=50)) == brute(of(odd_docs), block_words=50)
    assert mixing.measure(empty).count() == 0
    assert rows(mixing.measure(odd_docs.filter("size(split(trim(coalesce(text, '')), ' ')) < 2 AND length(coalesce(text, '')) < 9"))) == [
        (2, 0, 0, 0.0, 0), (3, 0, 0, 0.0, 0), (4, 0, 0, 0.0, 0)]


def test_partitioning_plays_no_part(spark, small):
    docs = small("documents")
    assert rows(mixing.measure(docs.repartition(7), block_words=500)) == rows(mixing.measure(docs.coalesce(1), block_words=500))
    other = rows(mixing.measure(docs, block_words=500, seed="other"))
    assert other != rows(mixing.measure(docs, block_words=500)) and sum(r[4] for r in other) >= 1.5 * sum(r[1] for r in other) - 20


@pytest.mark.parametrize("total, good, drawn", [(10, 4, 5), (50, 1, 25), (40, 40, 13), (300, 120, 150), (7, 3, 0), (100000, 700, 50000)])
def test_hypergeometric_frequencies(spark, total, good, drawn):
    n = 4000
    u = spark.range(n).select(((F.col("id") + 0.5) / n).alias("u"))
    got = {r[0]: r[1] for r in u.select(F.expr(mixing.hypergeometric("u", f"{total}L", f"{good}L", f"{drawn}L")).alias("k")).groupBy("k").count().collect()}
    ways = math.comb(total, drawn) if total < 1000 else None
    for k in range(max(0, drawn + good - total), min(good, drawn) + 1):
        if ways:
            assert abs(got.get(k, 0) / n - math.comb(good, k) * math.comb(total - good, drawn - k) / ways) < 2 / n
    mean = sum(k * c for k, c in got.items()) / n
    assert abs(mean - good * drawn / total) < 0.2


def test_tree_keeps_quotas(spark):
    quota = {0: 513, 1: 7, 3: 0, 4: 1, 9: 240}
    df = spark.createDataFrame(list(quota.items()), "sid long, quota long")
    for shards in (1, 2, 5, 37, 1000):
        got = mixing.split(df, shards).collect()
        by_source, by_shard = defaultdict(list), Counter()
        for r in got:
            by_source[r.sid].append((r.first, r.quota))
            by_shard[r.shard] += r.quota
        for s, q in quota.items():              # the draws of a source are dealt without gap or overlap
            end = 0
            for first, k in sorted(by_source[s]):
                assert first == end and k > 0
                end += k
            assert end == q
        seats = [by_shard[i] for i in range(shards)]
        assert sum(seats) == 761 and max(seats) - min(seats) <= 1


def test_mixed_corpus(spark, small):
    docs = small("documents")
    plan = mixing.Mix(docs, block_words=200)
    got = mixing.mix(docs, plan).collect()
    words, per_shard = Counter(), Counter()
    for r in got:
        assert len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) == r.words
        words[r.doc_id] += r.words
        per_shard[r.shard] += r.words
    want = {r[0]: r[4] for r in brute(of(docs), block_words=200) if r[4]}
    assert dict(words) == want and len(per_shard) == plan.shards
    assert max(len({(r.epoch) for r in got if r.doc_id == d}) for d in words) == 2
