import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from silverlode.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def exact():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def value():
    return bpe.Vocabulary(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


def test_pieces_match_the_library(exact, value, monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdeéß 12,.\n") for _ in range(rng.randrange(1, 400))) for _ in range(300)]
    texts += ["a" * 1500, "ab" * 900, "é" * 700, "<|endoftext|>", "", "  \n\n  x", "日本語テキスト🎉🎉", "\u0000\u0001"]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(n)) for n in (300, 1023, 1024, 1025, 5000)]
    codec = bpe.Codec(value)
    for some in (texts[:7], texts, texts[::-1]):
        for t, ids in zip(some, codec.encode(some)):
            assert ids == exact.encode_ordinary(t)
            assert codec.decode(ids) == t.encode()
    monkeypatch.setattr(bpe, "MEMO_PIECES", 3)
    assert [ids for ids in bpe.Codec(value).encode(texts)] == [exact.encode_ordinary(t) for t in texts]


def test_round_trip(spark, small, odd_docs, empty, exact):
    shared = bpe.vocabulary(spark, PATH, public_tokenizers.PATTERN)
    for docs in (small("documents"), odd_docs):
        want = []
        for doc_id, text in docs.select("doc_id", "text").collect():
            ids = exact.encode_ordinary(text or "")
            want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
        assert sorted(map(tuple, bpe.round_trip(docs, shared).collect()), key=repr) == sorted(want, key=repr)
    back = bpe.decode(bpe.encode(odd_docs, shared), shared).collect()
    assert sorted(bytes(r.data) for r in back) == sorted((r.text or "").encode() for r in odd_docs.collect())
    assert bpe.round_trip(empty, shared).count() == 0
    full = {r.doc_id: r for r in bpe.tokenize(small("documents"), shared).collect()}
    assert all(full[r.doc_id].ids == exact.encode_ordinary(r.text) and full[r.doc_id].n_tokens == len(full[r.doc_id].ids)
               and full[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest() for r in small("documents").collect())
