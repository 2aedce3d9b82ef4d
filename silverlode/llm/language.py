"""Language identification with string kernels.

A text is the set of its letter n-grams for n = 1, 2, 3 (other characters count as one
space), hashed to ``BUCKETS`` presence bits.  The blended-spectrum kernel of two texts is the size
of the common set over the geometric mean of their sizes.  ``LANDMARKS`` training texts give
Nystroem features, on which one ridge regression for each language is solved against
the rest.  Texts are scored in batches: presence matrix times landmark matrix times weights.

The fit sees a sample of at most ``SAMPLE_ROWS`` labelled rows, in equal shares by language
and chosen by a hash of doc_id, so it is the same in every run; whatever ids repeat, each language's share
is cut by rank before anything reaches the driver.  At most ``MAX_LANGS`` languages are learned.  The executors reduce each
sampled text, whole, to its bits; the driver never holds a text.

Cases: null text, or text without a letter, is ``und`` with score 0; rows without lang or
doc_id are never learned from (a null doc_id counts as not held out); without any
labelled row everything is ``und``; repeated rows are rows like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverlode.llm.arrays import mix, sliced

BUCKETS = 8192
LANDMARKS = 200
SAMPLE_ROWS = 3000
#: Languages learned, the most frequent ones (a landmark each at least).
MAX_LANGS = LANDMARKS
RIDGE = 1e-2
FOLDS = 5


def held_out() -> Column:
    """The fifth of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))


class _Letters:
    """Code point -> its lower-case letter, or a space."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            table = np.full(0x110000, 32, np.uint32)
            for c in range(0x110000):
                if (ch := chr(c)).isalpha():
                    low = ch.lower()
                    table[c] = ord(low) if len(low) == 1 else c
            cls.table = table
        return cls.table


def presence(text: str | None, out: np.ndarray) -> bool:
    """Set the bits of one whole text in ``out``; False if it has no letter."""
    if not text:
        return False
    c = _Letters.get()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    if not (c != 32).any():
        return False
    c = np.concatenate(([32], c, [32])).astype(np.uint64)
    c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]      # one space for many
    with np.errstate(over="ignore"):
        two = c[:-1] * np.uint64(0x1FFFFF) + c[1:]
        three = two[:-1] * np.uint64(0x1FFFFF) + c[2:]
        for n, g in ((1, c), (2, two), (3, three)):
            out[(mix(g * np.uint64(2) + np.uint64(n << 50)) >> np.uint64(51)).astype(np.int64) % BUCKETS] = 1
    return True


@dataclass
class Model:
    langs: list[str]
    landmarks: np.ndarray       # unit presence vectors, one row a landmark
    weights: np.ndarray         # landmarks x languages

    def scores(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        return (unit @ self.landmarks.T) @ self.weights


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        rows = []
        for lang, h, text in zip(*(b.column(i).to_pylist() for i in (0, 1, 2))):
            x = np.zeros(BUCKETS, np.uint8)
            if presence(text, x):
                rows.append((lang, h, np.packbits(x).tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.binary()))], ["lang", "h", "bits"])


def sample(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame | None:
    """lang, h, text of the rows to learn from, ``sample_rows`` at most; None without any."""
    train = docs.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # the most frequent languages, should a dirty column name more
    top = train.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max(1, min(MAX_LANGS, sample_rows)))
    counts = {r.lang: r.n for r in top.collect()}
    if not counts:
        return None
    share = sample_rows // len(counts)
    h = F.xxhash64(F.col("doc_id").cast("string"))
    # a hash range that holds a little over the share in expectation; the rest is cut inside the tasks, by order
    rank = F.shiftright(h, 1) + F.lit(2**62)                     # 0 .. 2^63
    limit = F.create_map(*(F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, 1.25 * share / n))))
    picked = train.filter(rank < limit[F.col("lang")] * float(2**63)).select("lang", h.alias("h"), "text")
    first = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))
    picked = picked.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= share)
    return picked.drop("place")


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    picked = sample(docs, sample_rows)
    if picked is None:
        return None
    rows = sorted(picked.mapInArrow(_bits, "lang string, h long, bits binary").collect())
    if not rows:
        return None
    langs = sorted({r.lang for r in rows})
    used = [r for lang in langs for r in rows if r.lang == lang]
    x = np.unpackbits(np.frombuffer(b"".join(r.bits for r in used), np.uint8).reshape(len(used), -1), axis=1).astype(np.float32)
    x /= np.sqrt(x.sum(1, keepdims=True))
    y = np.array([langs.index(r.lang) for r in used])
    each = max(1, landmarks // len(langs))
    chosen = np.concatenate([np.flatnonzero(y == k)[:each] for k in range(len(langs))])
    z = x[chosen]
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = (x @ z.T).astype(np.float64) @ root
    weight = len(y) / (len(langs) * np.bincount(y, minlength=len(langs)))[y]      # every language counts alike
    target = np.where(y[:, None] == np.arange(len(langs)), 1.0, -1.0)
    gram = (phi * weight[:, None]).T @ phi + ridge * len(y) * np.eye(phi.shape[1]) / 10
    w = np.linalg.solve(gram, (phi * weight[:, None]).T @ target)
    return Model(langs, z, (root @ w).astype(np.float32))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score.  Only the text decides."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # LANDMARKS x BUCKETS, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in sliced(batches):
            texts = b.column(2).to_pylist()
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            for i in range(0, len(texts) if m else 0, 256):
                x = np.zeros((min(256, len(texts) - i), BUCKETS), np.float32)
                has = np.flatnonzero([presence(t, row) for t, row in zip(texts[i:i + 256], x)])
                if len(has):
                    s = m.scores(x[has])
                    e = np.exp(4 * (s - s.max(1, keepdims=True)))
                    best = s.argmax(1)
                    score[i + has] = (e / e.sum(1, keepdims=True))[np.arange(len(has)), best]
                    for k, j in zip(has.tolist(), best.tolist()):
                        lang[i + k] = m.langs[j]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang), pa.array(score)],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    return predict(docs, fit(docs, **options))
