"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document has one latent score: the sum of shared weights of its hashed features.
Ordered thresholds cut the scale into grades, P(grade >= k) = sigmoid(score - threshold k), so
expected grade and tail probabilities come from one set of weights.  Grades:
0 toxic, 1 poor, 2 good.

Features are the distinct lower-cased words of the whole text, and binned shares of capitals,
punctuation marks, final characters and repeated neighbours, all hashed to ``BUCKETS``.

The fit sees at most ``SAMPLE_ROWS`` rated documents (the bound), chosen by a hash of
doc_id, and cut to that number before the driver sees any; only hashed features reach it.  Features in fewer than
``MIN_DOCS`` of them, or a share of ``MIN_SHARE``, get no weight.  Every document is scored, whole, without a shuffle.

Cases: a null or empty text has only its shape features and is scored like any other text;
a rating with a null quality or toxic is not learned from; several ratings of a
document count as its lowest; without ratings every document gets the uniform grades; null ids are
scored but never rated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.arrays import LOWER, SPACED, Texts, sliced, texts_of, word_hashes, words_of
from silverlode.llm.shared import keyed_text

BUCKETS = 1 << 18
SAMPLE_ROWS = 12_000
MIN_DOCS, MIN_SHARE = 5, 0.003
PENALTY = 1e-3
GRADES = 3
KEEP_TAIL = 0.5
_EDGE = np.zeros(256, bool)
_EDGE[list(b".,;:!?\"'()[]{}*#$%&|<>")] = True
_BINS = np.array([0.001, 0.01, 0.03, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9])


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all documents, and where each document's begin."""
    raw = texts_of(column)
    texts = Texts(LOWER[raw.buf], raw.at)
    # marks at a word's edges are no part of it: words lie between white space and marks
    words = words_of(texts, SPACED & ~_EDGE)
    h = word_hashes(texts, words)
    n = len(raw)
    doc = np.repeat(np.arange(n), words.counts)
    word = (h >> np.uint64(64 - 18)).astype(np.int64)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    size = np.maximum(np.diff(raw.at), 1)
    count = np.maximum(words.counts, 1)
    run = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[raw.at])
    shapes = [np.bincount(doc, same, n) / count, run((raw.buf >= 65) & (raw.buf <= 90)) / size,
              *(run(raw.buf == c) / size for c in b"|#*$%&!.,\n<>{}=0"), np.minimum(count / 1000, 1.0), run(raw.buf > 127) / size]
    every = [doc * BUCKETS + word]
    for k, share in enumerate(shapes):
        every.append(np.arange(n) * BUCKETS + k * (len(_BINS) + 1) + np.searchsorted(_BINS, share))
    flat = np.unique(np.concatenate(every))
    return flat % BUCKETS, np.searchsorted(flat // BUCKETS, np.arange(n + 1))


@dataclass
class Model:
    weights: np.ndarray         # BUCKETS floats
    thresholds: np.ndarray      # GRADES - 1, increasing

    def tails(self, index: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. GRADES - 1, one row a document."""
        total = np.concatenate(([0.0], np.cumsum(self.weights[index], dtype=np.float64)))
        score = total[first[1:]] - total[first[:-1]]
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -40, 40)))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        index, first = features(b.column(1))
        rows = [index[first[i]:first[i + 1]].astype(np.int32).tobytes() for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(rows, pa.binary())], ["doc_id", "grade", "bits"])


def ratings(labels: DataFrame) -> DataFrame:
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return labels.filter("doc_id is not null and quality is not null and toxic is not null") \
        .groupBy("doc_id").agg(F.min(grade).alias("grade"))


def sample(docs: DataFrame, rated: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, grade and features of the documents to learn from, ``sample_rows`` at most."""
    h = F.shiftright(F.xxhash64(F.col("doc_id"), F.lit("rated")), 1) + F.lit(2**62)
    n = rated.count()
    picked = rated.filter(h < min(1.0, sample_rows / max(n, 1)) * float(2**63))
    chosen = keyed_text(docs).join(picked, "doc_id").select("doc_id", "text", "grade")
    # a repeated id brings all its rows: the first ones by hash are taken before anything reaches the driver
    found = chosen.mapInArrow(_sparse, "doc_id long, grade int, bits binary")
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", "grade", "bits").limit(sample_rows)


def fit(docs: DataFrame, rated: DataFrame, sample_rows: int = SAMPLE_ROWS, rounds: int = 250, penalty: float = PENALTY) -> Model:
    """Full-batch Adam on the penalised likelihood of the sample."""
    found = sample(docs, rated, sample_rows)
    rows = sorted(found.collect(), key=lambda r: (r.doc_id, r.grade, r.bits))
    weights, cuts = np.zeros(BUCKETS), np.array([-0.7, 0.7])
    if not rows:
        return Model(weights, cuts)
    index = np.concatenate([np.frombuffer(r.bits, np.int32) for r in rows])
    doc = np.repeat(np.arange(len(rows)), [len(r.bits) // 4 for r in rows])
    common = np.bincount(index, minlength=BUCKETS) >= max(MIN_DOCS, MIN_SHARE * len(rows))
    index, doc = index[common[index]], doc[common[index]]
    used, index = np.unique(index, return_inverse=True)
    grade = np.array([r.grade for r in rows])
    share = 1 / np.sqrt(np.maximum(np.bincount(grade, minlength=GRADES), 1))[grade]      # rare grades count more
    share /= share.sum()
    ones = (grade[:, None] > np.arange(GRADES - 1)).astype(float)
    w, t = np.zeros(len(used)), cuts.copy()
    m, v, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)
    for i in range(1, rounds + 1):
        score = np.bincount(doc, w[index], len(rows))
        cum = 1 / (1 + np.exp(-np.clip(score[:, None] - t, -40, 40)))       # P(y > k)
        # gradient of the likelihood of the observed grade, the difference of two tails
        upper = np.where(grade < GRADES - 1, cum[np.arange(len(rows)), np.minimum(grade, GRADES - 2)], 0.0)
        lower = np.where(grade > 0, cum[np.arange(len(rows)), np.maximum(grade - 1, 0)], 1.0)
        p = np.maximum(lower - upper, 1e-9)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        g = -share * (dl - du) / p
        gw = np.bincount(index, g[doc], len(used)) + penalty * w
        gt = np.zeros_like(t)
        np.add.at(gt, np.maximum(grade - 1, 0), np.where(grade > 0, share * dl / p, 0))
        np.add.at(gt, np.minimum(grade, GRADES - 2), np.where(grade < GRADES - 1, -share * du / p, 0))
        for x, gx, mx, vx, rate in ((w, gw, m, v, 0.03), (t, gt, mt, vt, 0.03)):
            mx += 0.1 * (gx - mx)
            vx += 0.001 * (gx * gx - vx)
            x -= rate * (mx / (1 - 0.9**i)) / (np.sqrt(vx / (1 - 0.999**i)) + 1e-7)
        t.sort()
    weights[used] = w
    return Model(weights, t)


def grade(docs: DataFrame, model: Model, keep_tail: float = KEEP_TAIL) -> DataFrame:
    """doc_id, expected_grade (0 to 2), p_above_0, p_above_1 and keep (p_above_1 >= keep_tail)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # BUCKETS floats, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            tails = shared.value.tails(*features(b.column(1)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(tails.sum(1)), pa.array(tails[:, 0]), pa.array(tails[:, 1]), pa.array(tails[:, 1] >= keep_tail)],
                ["doc_id", "expected_grade", "p_above_0", "p_above_1", "keep"])

    return keyed_text(docs).mapInArrow(run, "doc_id long, expected_grade double, p_above_0 double, p_above_1 double, keep boolean")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return grade(docs, fit(docs, ratings(labels), **options))
