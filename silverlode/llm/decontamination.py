"""Benchmark decontamination with suffix arrays over the training words.

Each batch of documents is a shard.  Its word-level suffix array holds the places
from which a test window could start: places whose next words all occur in the
benchmark block (any other suffix differs from every test suffix before the
window ends).  Every test suffix is looked up by binary search in every shard; the
range found gives all places that share the window, and neighbouring places on
one diagonal give the longest verbatim match.

A document never leaves its task: there is no shuffle over the documents.  The
benchmark is worked through in blocks of ``block_words`` words, each broadcast on
its own, so what a task holds does not grow with the benchmark.  With several
blocks only documents with hits meet again, in one aggregate by document.

Cases: a null or wordless text has no words and no hits; a null or wordless item
text has no window; a short item is one window; items with equal text are all
reported; items without an id count like any other, and in the list of ids all of them
are one null, which ``n_items`` counts and ``items_sha256`` leaves out, as the SQL does;
documents with equal or null ids are separate rows; an empty benchmark leaves all documents
clean.  Columns other than ids and texts are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm.arrays import (
    BYTE_VALUE, LETTERED, LOWER, Texts, covered, runs_of, sliced, texts_of, word_hashes, words_of,
)
from silverlode.llm.shared import keyed_text, written

WINDOW = 10
BLOCK_WORDS = 2_000_000
COLUMNS = ("doc_id long, n_words long, hits array<struct<first:long,last:long>>, items array<string>, "
           "longest long, longest_at long, longest_item string")


def _lower_words(column: pa.Array):
    raw = texts_of(column)
    texts = Texts(LOWER[raw.buf], raw.at)
    words = words_of(texts, LETTERED)
    return words, word_hashes(texts, words, BYTE_VALUE)


class TestBlock:
    """The windows of a block of items, as packed word numbers in sorted order."""

    def __init__(self, item_ids: list[str], column: pa.Array, window: int):
        words, h = _lower_words(column)
        self.items, self.window = np.array(item_ids, dtype=object), window
        self.vocab = np.unique(h)
        ids = np.searchsorted(self.vocab, h).astype(np.uint64) + np.uint64(1)   # 0: a word of no item
        n = words.counts
        self.lengths = [int(x) for x in np.unique(np.where(n >= window, window, n)) if x > 0]
        self.bits = int(len(self.vocab) + 1).bit_length()
        self.groups = []
        for size in self.lengths:                       # full windows, and each length of short items
            own = np.flatnonzero(n >= window) if size == window else np.flatnonzero(n == size)
            k = n[own] - size + 1
            item = np.repeat(own, k)
            offset = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            keys = pack(ids, words.first[:-1][item] + offset, size, self.bits)
            order = np.lexsort(tuple(keys[::-1]))
            keys = [x[order] for x in keys]
            new = np.ones(len(order), bool)
            if len(order):
                new[1:] = np.any([x[1:] != x[:-1] for x in keys], axis=0)
            begin = np.append(np.flatnonzero(new), len(order))
            self.groups.append((size, [x[new] for x in keys], begin, item[order], offset[order]))

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Word numbers of hashes, 0 for words that no item has."""
        if not len(self.vocab):
            return np.zeros(len(h), np.uint64)
        i = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        return np.where(self.vocab[i] == h, i + 1, 0).astype(np.uint64)


def pack(ids: np.ndarray, at: np.ndarray, size: int, bits: int) -> list[np.ndarray]:
    """The next ``size`` word numbers of each place as a few 64-bit keys, in order."""
    per = max(1, 63 // bits)
    keys = []
    for a in range(0, size, per):
        key = np.zeros(len(at), np.uint64)
        for j in range(a, min(a + per, size)):
            key = (key << np.uint64(bits)) | ids[at + j]
        keys.append(key)
    return keys


def search(sa_keys: list[np.ndarray], queries: list[np.ndarray], side: str) -> np.ndarray:
    """Binary search of all queries at once in keys sorted as tuples."""
    n, m = len(sa_keys[0]), len(queries[0])
    lo, hi = np.zeros(m, np.int64), np.full(m, n, np.int64)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = np.minimum((lo + hi) // 2, n - 1)
        before, equal = np.zeros(m, bool), np.ones(m, bool)
        for s, q in zip(sa_keys, queries):
            v = s[mid]
            before |= equal & (v < q)
            equal &= v == q
        if side == "right":
            before |= equal
        lo = np.where(open_ & before, mid + 1, lo)
        hi = np.where(open_ & ~before, mid, hi)


def match_shard(block: TestBlock, h: np.ndarray, first: np.ndarray):
    """Per document of the shard: hit word mask, items, longest match."""
    ids = block.numbers(h)
    n = len(ids)
    hit = np.zeros(n, bool)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs: list[np.ndarray] = []
    longest: dict[int, tuple[int, int, int]] = {}
    miss = np.concatenate(([0], np.cumsum(ids == 0)))
    for size, keys, begin, item, offset in block.groups:
        place = np.arange(max(0, n - size + 1))
        ok = (miss[size:] - miss[:n - size + 1] == 0) if len(place) else np.zeros(0, bool)
        if len(place):
            ok &= place + size <= first[owner[place] + 1]
        place = place[ok]
        if not len(place):
            continue
        suffix = pack(ids, place, size, block.bits)
        order = np.lexsort(tuple(suffix[::-1]))
        place, suffix = place[order], [x[order] for x in suffix]      # the shard's suffix array
        lo, hi = search(suffix, keys, "left"), search(suffix, keys, "right")
        found = np.flatnonzero(hi > lo)
        if not len(found):
            continue
        k = (hi - lo)[found]
        window = np.repeat(found, k)
        pos = place[np.repeat(lo[found] - (np.cumsum(k) - k), k) + np.arange(k.sum())]
        hit |= covered(n, pos, pos + size)
        # windows of a document, then the items that have them
        seen = np.unique(owner[pos] * len(keys[0]) + window)
        doc, w = seen // len(keys[0]), seen % len(keys[0])
        c = (begin[1:] - begin[:-1])[w]
        entry = np.repeat(begin[w] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        pairs.append(np.unique(np.repeat(doc, c) * len(block.items) + item[entry]))
        # longest verbatim match: successive places on the diagonal of one occurrence
        at = begin[window]
        diagonal = np.lexsort((pos, pos - offset[at], item[at]))
        p, it, dg = pos[diagonal], item[at][diagonal], (pos - offset[at])[diagonal]
        breaks = np.ones(len(p), bool)
        breaks[1:] = (p[1:] != p[:-1] + 1) | (it[1:] != it[:-1]) | (dg[1:] != dg[:-1]) | (owner[p[1:]] != owner[p[:-1]])
        head = np.flatnonzero(breaks)
        length = np.diff(np.append(head, len(p))) + size - 1
        for d, l, a, i in zip(owner[p[head]].tolist(), length.tolist(), p[head].tolist(), it[head].tolist()):
            if l > longest.get(d, (0, 0, 0))[0]:
                longest[d] = (l, a - int(first[d]), i)
    return hit, np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64), longest


def _ids(items: list) -> list:
    """Distinct ids in order, null last."""
    return sorted({x for x in items if x is not None}) + [None] * (None in items)


def _matcher(block_value, only_hits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = block_value.value
        for b in sliced(batches):
            words, h = _lower_words(b.column(1))
            hit, pairs, longest = match_shard(block, h, words.first)
            doc_of, item_of = pairs // max(1, len(block.items)), pairs % max(1, len(block.items))
            cut = np.searchsorted(doc_of, np.arange(b.num_rows + 1))
            rows = []
            for d, (doc_id, n) in enumerate(zip(b.column(0).to_pylist(), words.counts.tolist())):
                mine = item_of[cut[d]:cut[d + 1]]
                if not len(mine):
                    if not only_hits:
                        rows.append((doc_id, n, [], [], 0, None, None))
                    continue
                s, e = runs_of(hit[words.first[d]:words.first[d + 1]])
                l, a, i = longest[d]
                rows.append((doc_id, n, [{"first": x, "last": y} for x, y in zip(s.tolist(), e.tolist())],
                             _ids(block.items[mine].tolist()), l, a, block.items[i]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW)], NAMES)
    return run


NAMES = ["doc_id", "n_words", "hits", "items", "longest", "longest_at", "longest_item"]
ARROW = [pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])),
         pa.list_(pa.string()), pa.int64(), pa.int64(), pa.string()]


def _blocks(spark: SparkSession, benchmark: DataFrame, window: int, block_words: int):
    """Broadcasts of the items in blocks: each is read by its own filter, of bounded size."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // (block_words * 6)))         # about six bytes a word
    for b in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        rows = part.collect()                               # one block of the stated query set
        block = TestBlock([r[0] for r in rows], pa.array([r[1] for r in rows], pa.large_string()), window)
        yield spark.sparkContext.broadcast(block)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: word count, hit word ranges [first, last), ids of items with
    a window in it (null for those without an id), and its longest verbatim match (words, place, item)."""
    spark = docs.sparkSession
    docs = keyed_text(docs)
    found = [docs.mapInArrow(_matcher(b, False), COLUMNS) for b in _blocks(spark, benchmark, window, block_words)]
    if len(found) == 1:
        return found[0]
    # Several blocks: number the rows, keep the hits of every block, and unite them by row.
    kept, _ = written(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    texts = kept.select(F.col("row").alias("doc_id"), "text")
    union = None
    for k, b in enumerate(_blocks(spark, benchmark, window, block_words)):
        part, _ = written(texts.mapInArrow(_matcher(b, k > 0), COLUMNS), "overlaps")
        union = part if union is None else union.unionByName(part)
    best = F.max_by(F.struct("longest", "longest_at", "longest_item"), "longest")
    merged = union.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), best.alias("best"),
    ).withColumnRenamed("doc_id", "row")
    # ranges of different blocks may overlap: unite them in order of their starts
    merged = merged.withColumn("hits", F.expr("""
        aggregate(array_sort(hits), cast(array() as array<struct<first:bigint,last:bigint>>), (a, x) ->
            if(size(a) > 0 and x.first <= element_at(a, -1).last,
               concat(slice(a, 1, size(a) - 1), array(named_struct('first', element_at(a, -1).first,
                      'last', greatest(element_at(a, -1).last, x.last)))),
               concat(a, array(x))))"""))
    return kept.select("row", "doc_id").join(merged, "row").select("doc_id", "n_words", "hits", "items", "best.*")


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The digest of ``find_overlaps``: counts, items and the verdict."""
    n_hit = F.expr("aggregate(hits, 0L, (a, x) -> a + x.last - x.first)")
    return find_overlaps(docs, benchmark, **options).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.col("longest").alias("longest_match"), F.col("longest_at").alias("longest_match_at"),
        F.col("longest_item").alias("longest_match_item"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without any hit, with all their columns.

    The rows pass through the blocks one after the other in the task that reads them, so
    removal needs no join and rows without a doc_id are judged as well."""
    place = docs.columns.index("text")

    def clean(block_value):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in sliced(batches):
                words, h = _lower_words(b.column(place))
                hit, _, _ = match_shard(block_value.value, h, words.first)
                seen = np.concatenate(([0], np.cumsum(hit)))
                yield b.filter(pa.array(seen[words.first[1:]] == seen[words.first[:-1]]))
        return run

    for block_value in _blocks(docs.sparkSession, benchmark, window, block_words):
        docs = docs.mapInArrow(clean(block_value), docs.schema)
    return docs
