import random

import numpy as np
import public_tokenizers
import tiktoken

from silverlode.llm import bpe, token_counts as tc

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_documents_round_trip(spark, small, odd_docs, empty, tmp_path):
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    shared = bpe.vocabulary(spark, PATH, public_tokenizers.PATTERN)
    for k, docs in enumerate((small("documents"), odd_docs)):
        want = sorted(((r.doc_id, len(exact.encode_ordinary(r.text or ""))) for r in docs.collect()), key=repr)
        assert sorted((tuple(r)[:2] for r in tc.measure(docs, shared, 50256).collect()), key=repr) == want
        path = str(tmp_path / f"t{k}")                 # blocks far smaller than documents
        tc.write_token_files(docs, path, shared, 50256, block_tokens=7)
        assert sorted((tuple(r)[:2] for r in tc.document_counts(spark, path, 50256).collect()), key=repr) == want
    assert tc.measure(empty, shared, 50256).count() == 0


def brute(ids, sep):
    out, n = [], 0
    for x in ids:
        if x == sep:
            out.append((n, True))
            n = 0
        else:
            n += 1
    return out + ([(n, False)] if n else [])


def test_stitching(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tc, "GROUP", 3)
    rng, rows, want = random.Random(5), [], []
    for f in range(12):
        ids = np.array([9 if rng.random() < (0, 0.02, 0.3, 1)[f % 4] else 1 for _ in range(rng.randrange(0, 200))], "<u4")
        for b in range(0, len(ids), 5):
            rows.append((f, b // 5, ids[b:b + 5].tobytes()))
        want += [(f, k, n, done) for k, (n, done) in enumerate(brute(ids, 9))]
        ids.tofile(tmp_path / f"{f}.bin")
    blocks = spark.createDataFrame(rows, "file long, block long, tokens binary").repartition(4)
    got = tc.count_tokens(tc.scan(blocks, 9, 4)).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    raw = tc.count_tokens(tc.scan(tc.read_raw_files(spark, str(tmp_path), 4, 11), 9, 4)).collect()
    assert sorted((r.n_tokens, r.finished, r.ordinal) for r in raw) == sorted((n, d, k) for _, k, n, d in want)
    assert tc.count_tokens(tc.scan(blocks.filter("false"), 9, 4)).count() == 0
