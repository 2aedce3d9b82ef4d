from test_ngram_join import brute, rows
import random
from silverlode.llm import ngram_join as nj


def test_large_components_and_outliers(spark, monkeypatch):
    """Tiles of a few sets: components of more than a tile meet what is not in them."""
    monkeypatch.setattr(nj, "TILE", 4)
    rng, docs = random.Random(3), []
    for g in range(3):
        base = [f"g{g}w{i}" for i in range(60)]
        for _ in range(30):
            w = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 3))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            docs.append((len(docs), " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = brute(docs)
    assert len({c for *_, c in want}) > 3
    assert rows(nj.near_duplicates(df)) == want
