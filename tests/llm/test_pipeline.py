import hashlib
import re

import public_tokenizers
import tiktoken
from test_decontamination import brute as overlaps
from test_ngram_join import brute as near
from test_pii import base

import __spark_entry__ as entry
import corpus_pipeline
from silverlode.llm import bpe, queries
from test_quality_rules import brute as measures


def rejected(text):
    """All rules, from the plain text."""
    n, chars, symbols, dup, repeat, failed = measures(text)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    letters = [c for c in text or "" if c.isalpha()]
    upper = sum(c.isupper() for c in letters)
    return failed or 100 * symbols > 10 * n or 100 * dup > 30 * len(lines) or not 2 * n <= chars <= 15 * n or 100 * upper > 70 * len(letters)


def masked(text):
    spans, out, end = sorted((s, -e, k) for k, s, e in base(text)), [], 0
    merged = []
    for s, e, k in spans:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], -e)
        else:
            merged.append([s, -e, k])
    for s, e, k in merged:
        out += [text[end:s], f"[{k}]"]
        end = e
    return "".join(out) + text[end:]


def test_stages_against_brute_force(spark, small):
    sf = "/root/testdata/sf0.01"
    docs = small("documents", sf)
    rows = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in small("benchmark", sf).collect()]
    rows = {i: t for i, t in rows.items() if not rejected(t)}
    rows = {i: rows[i] for i, _, c in near(list(rows.items())) if i == c}
    rows = {i: rows[i] for i, *_, bad in overlaps(list(rows.items()), items) if not bad}
    rows = {i: masked(t) for i, t in rows.items()}
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(corpus_pipeline.RANKS), special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert got.keys() == rows.keys() and 100 < len(rows) < docs.count()
    for i, t in rows.items():
        assert got[i].ids == exact.encode_ordinary(t) and got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_stages_on_odd_rows(spark, odd_docs, empty, tmp_path):
    """Every stage takes nulls, empty tables, repeated rows and clashing names."""
    items = spark.createDataFrame([(1, "one two"), (2, None)], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd_docs, empty, odd_docs.drop("n_chars", "lang")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            out.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {re.match(r"op\d+", q)[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert set(queries.SQL) <= set(queries.QUERIES)
