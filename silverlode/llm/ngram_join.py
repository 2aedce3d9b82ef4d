"""Exact Jaccard join of word n-gram sets with prefix trees.

1. Every text becomes its set of shingles; texts with equal sets (by a 64-bit fingerprint) are one
   class from here on, so copies cost nothing more.
2. Shingles meet by hash range and get their class frequency, which is the global order: rare
   first.  A shingle of one class alone can be in no overlap.  A class with less than the
   threshold share of its shingles in other classes has no link and leaves.
3. The rest are indexed by the first tokens of their ordered sets: any two linked sets share one
   of the first |A| - ceil(t |A|) + 1 (prefix filter).
4. Candidates are verified against a probe's set in a prefix tree: the ordered sets of one probe's candidates are
   sorted, so that equal beginnings lie together; the overlap up to the common beginning
   carries over from one set to the next, and a set is left as soon as what remains of
   it cannot reach the overlap it needs.
5. A posting list of m similar sets is not expanded into m^2 pairs.  ``ROUNDS`` times each list
   links its members to a leader, which settles groups of copies.  Lists that still hold several components
   are joined exactly, in tiles: a probe walks the tree of a chunk past everything it is connected with
   already, so no link that matters to a component is lost and pairs are never rows.

Lists and probes are split over tasks by hash, whatever the size of a group; blocks of numbers
are exchanged instead of rows; tables between steps lie in the shared folder.

Cases: null, empty and blank texts have an empty set and are linked with nothing; a text of fewer words than
a shingle is one shingle; rows without doc_id are counted but form no links and have no
component; rows that share a doc_id are joined in one component by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from silverlode.llm.arrays import LOWER, SPACED, Texts, mix, sequence_hash, sliced, texts_of, windows_of, word_hashes, words_of
from silverlode.llm.components import connected
from silverlode.llm.exchange import DEAL_BYTES, PART_BYTES, batch, bucket_of, cuts, dealt, joined, pack, part_of, parts_for, unpack
from silverlode.llm.shared import keyed_text, release, text_bytes, written

SHINGLE = 5
PERCENT = 75
ROUNDS = 1
PROBE_CHUNK = 2000
TILE = 1000
#: Text bytes behind one part.  A block names its classes once, so fewer parts move fewer names.
SET_BYTES = 2 * PART_BYTES
#: Shingle ids keep the upper 48 bits of the hash: two of one pair's shingles are confused with odds of |A||B| / 2^48.
_ID = np.uint64(16)
SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64())])
BLOCK = pa.schema([("part", pa.int64()), ("h", pa.binary()), ("own", pa.binary()), ("cls", pa.binary()), ("n", pa.binary()), ("df", pa.binary())])
BLOCK_SQL = "part long, h binary, own binary, cls binary, n binary, df binary"
MEMBER = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary())])


def need(a, b, percent: int = PERCENT):
    """Least intersection of linked sets of a and b: 100 i >= percent (a + b - i)."""
    return -(-(percent * (a + b)) // (100 + percent))


def shingle_sets(column: pa.Array, size: int):
    """Sorted distinct shingles of all texts (hash, owner), and each text's class fingerprint and set size."""
    raw = texts_of(column)
    texts = Texts(LOWER[raw.buf], raw.at)
    words = words_of(texts, SPACED)
    start, owner = windows_of(words, size, short=True)
    h = sequence_hash(word_hashes(texts, words), start, np.minimum(words.counts, size)[owner])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    n = np.bincount(owner, minlength=len(raw))
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(0x51ED)), dtype=np.uint64)))
        at = np.concatenate(([0], np.cumsum(n)))
        cls = mix((total[at[1:]] - total[at[:-1]]) ^ mix(n.astype(np.uint64))).view(np.int64)
    return h, owner, n, cls


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            _, _, n, cls = shingle_sets(b.column(1), size)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(cls)], schema=SETS)
    return run


def _blocks(part: np.ndarray, h: np.ndarray, cls: np.ndarray, n: np.ndarray, df: np.ndarray | None = None) -> Iterator[tuple]:
    """Rows of BLOCK for entries sorted by part; classes are named once a block."""
    names, at = cuts(part)
    for p, i, j in zip(names.tolist(), at[:-1].tolist(), at[1:].tolist()):
        ids, first, own = np.unique(cls[i:j], return_index=True, return_inverse=True)
        kind = np.uint16 if len(ids) < 65536 else np.uint32
        yield (p, pack(h[i:j]), kind().itemsize.to_bytes(1, "little") + pack(own.astype(kind)), pack(ids), pack(n[i:j][first].astype(np.uint32)),
               b"" if df is None else pack(df[i:j].astype(np.uint32)))


def _entries(table: pa.Table):
    h, cls, n, df = [], [], [], []
    for row in table.select(["h", "own", "cls", "n", "df"]).to_pylist():
        own = unpack(row["own"][1:], np.uint16 if row["own"][0] == 2 else np.uint32)
        h.append(unpack(row["h"], np.uint64))
        cls.append(unpack(row["cls"], np.int64)[own])
        n.append(unpack(row["n"], np.uint32)[own])
        df.append(unpack(row["df"], np.uint32))
    return np.concatenate(h), np.concatenate(cls), np.concatenate(n).astype(np.int64), np.concatenate(df)


def _send(parts: int, size: int):
    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        n = np.array([len(x) for x in held.values()])
        h, cls = np.concatenate(list(held.values())), np.repeat(np.fromiter(held, np.int64, len(held)), n)
        order = np.argsort(h, kind="stable")
        h, cls, n = h[order], cls[order], np.repeat(n, n)[order]
        rows = list(_blocks(part_of(h, parts), h >> _ID, cls, n))
        for i in range(0, len(rows), 32):
            yield batch(rows[i:i + 32], BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size_held = {}, 0
        for b in sliced(batches):
            h, _, n, cls = shingle_sets(b.column(1), size)
            at = np.concatenate(([0], np.cumsum(n)))
            for i, c in enumerate(cls.tolist()):
                if n[i] and c not in held:           # copies leave a task once
                    held[c] = h[at[i]:at[i + 1]]
                    size_held += 6 * int(n[i])
            if size_held >= DEAL_BYTES:
                yield from flush(held)
                held, size_held = {}, 0
        yield from flush(held)
    return run


def _count(parts: int):
    """Entries of shingles that several classes have, with their frequency, to the class's bucket."""
    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return BLOCK.empty_table()
        h, cls, n, _ = _entries(table)
        order = np.lexsort((cls, h))
        h, cls, n = h[order], cls[order], n[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (cls[1:] != cls[:-1])      # the class from several tasks
        h, cls, n = h[keep], cls[keep], n[keep]
        _, at = cuts(h)
        df = np.repeat(np.diff(at), np.diff(at))
        shared = df > 1
        h, cls, n, df = h[shared], cls[shared], n[shared], df[shared]
        q = bucket_of(cls, parts)
        order = np.lexsort((h, cls, q))
        return pa.Table.from_batches([batch(list(_blocks(q[order], h[order], cls[order], n[order], df[order])), BLOCK)], BLOCK)
    return run


def _assemble(percent: int):
    """Classes with enough shared shingles, those in global order (frequency, then id)."""
    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return MEMBER.empty_table()
        h, cls, n, df = _entries(table)
        order = np.lexsort((h, df, cls))
        h, cls, n = h[order], cls[order], n[order]
        ids, at = cuts(cls)
        rows = [(c, int(n[i]), pack(h[i:j])) for c, i, j in zip(ids.tolist(), at[:-1].tolist(), at[1:].tolist())
                if 100 * (j - i) >= percent * int(n[i])]
        return pa.Table.from_batches([batch(rows, MEMBER)], MEMBER)
    return run


def _postings(parts: int, percent: int):
    """The index tokens of each member, dealt to token parts."""
    def flush(h: list, cls: list, n: list) -> Iterator[pa.RecordBatch]:
        if h:
            k = np.array([len(x) for x in h])
            h, cls, n = np.concatenate(h), np.repeat(cls, k), np.repeat(n, k)
            part = part_of(mix(h), parts)
            order = np.lexsort((h, part))
            rows = list(_blocks(part[order], h[order], cls[order], n[order]))
            for i in range(0, len(rows), 32):
                yield batch(rows[i:i + 32], BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, cls, n, held = [], [], [], 0
        for b in batches:
            for c, size, tokens in zip(*(x.to_pylist() for x in b.columns)):
                t = unpack(tokens, np.uint64)
                # the unshared shingles come first in the order: they take up part of the prefix
                prefix = t[:len(t) - (-(-percent * size // 100)) + 1]
                h.append(prefix), cls.append(c), n.append(size)
                held += len(prefix)
            if held >= 1 << 20:
                yield from flush(h, cls, n)
                h, cls, n, held = [], [], [], 0
        yield from flush(h, cls, n)
    return run


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _unique_pairs(a: list, b: list) -> pa.Table:
    if not a:
        return PAIRS.empty_table()
    a, b = np.concatenate(a), np.concatenate(b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return pa.table([a[keep], b[keep]], schema=PAIRS)


def _sorted_lists(table: pa.Table):
    """Entries by token and size, and where each token's list begins."""
    h, cls, n, _ = _entries(table)
    order = np.lexsort((cls, n, h))
    h, cls, n = h[order], cls[order], n[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (cls[1:] != cls[:-1])
    h, cls, n = h[keep], cls[keep], n[keep]
    return h, cls, n, cuts(h)[1]


def _leaders(round_: int, percent: int):
    """(leader, member) for each list: the leader is its least member by a hash of the round,
    among the members of similar size."""
    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return PAIRS.empty_table()
        h, cls, n, at = _sorted_lists(table)
        # sizes within a band of the threshold's width share a leader
        band = np.floor(np.log(np.maximum(n, 1)) / -np.log(percent / 100) + 0.5 * (round_ % 2)).astype(np.int64)
        with np.errstate(over="ignore"):
            rank = mix(cls.view(np.uint64) + np.uint64(round_ * 77 + 5))
        order = np.lexsort((rank, band, h))
        h, cls, n, band = h[order], cls[order], n[order], band[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (band[1:] != band[:-1])
        first = np.flatnonzero(new)
        k = np.diff(np.append(first, len(h)))
        lead, size = np.repeat(cls[first], k), np.repeat(n[first], k)
        ok = (lead != cls) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))
        return _unique_pairs([lead[ok]], [cls[ok]])
    return run


def _open_lists(left: pa.Table, right: pa.Table) -> pa.Table:
    """(leader, member) for every list whose members lie in different components."""
    if not left.num_rows:
        return PAIRS.empty_table()
    h, cls, n, at = _sorted_lists(left)
    node, root = right.column("node").to_numpy(), right.column("root").to_numpy()
    order = np.argsort(node)
    node, root = node[order], root[order]
    comp = cls
    if len(node):
        i = np.minimum(np.searchsorted(node, cls), len(node) - 1)
        comp = np.where(node[i] == cls, root[i], cls)
    k = np.diff(at)
    mixed = np.repeat(np.minimum.reduceat(comp, at[:-1]) != np.maximum.reduceat(comp, at[:-1]), k)
    lead = np.repeat(np.minimum.reduceat(cls, at[:-1]), k)
    return _unique_pairs([lead[mixed]], [cls[mixed]])


class Tree:
    """Ordered sets in a prefix tree, stored as their sorted rows: rows with a common
    beginning are neighbours, and ``shared`` is the depth at which a row leaves the path of the row before."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].tobytes())
        self.sets = sets
        self.shared, before = [], np.zeros(0, np.uint64)
        for i in self.order:
            k = min(len(sets[i]), len(before))
            differs = np.flatnonzero(sets[i][:k] != before[:k])
            self.shared.append(int(differs[0]) if len(differs) else k)
            before = sets[i]

    def linked(self, probe: np.ndarray, probe_n: int, sizes: list[int], percent: int = PERCENT, wanted=None):
        """Yields the sets linked with the probe.  The overlap along a path is carried from row to row;
        a row is left as soon as the rest of it cannot make up what is missing.  ``wanted(i)`` may turn rows down."""
        inside = np.sort(probe)
        run, depth_known = np.zeros(1, np.int64), 0
        for i, shared in zip(self.order, self.shared):
            # what of the path walked so far this row still shares
            depth_known = min(depth_known, shared)
            if wanted is not None and not wanted(i):
                continue
            s, want = self.sets[i], need(probe_n, sizes[i], percent)
            depth, run = depth_known, run[:depth_known + 1]
            while depth < len(s) and run[-1] + len(s) - depth >= want:
                step = s[depth:depth + 64]
                at = np.minimum(np.searchsorted(inside, step), len(inside) - 1)
                run = np.concatenate((run, run[-1] + np.cumsum(inside[at] == step)))
                depth += len(step)
            depth_known = depth
            if depth == len(s) and run[-1] >= want:
                yield i


def tree_overlaps(probe: np.ndarray, probe_n: int, sets: list[np.ndarray], sizes: list[int], percent: int = PERCENT) -> list[int]:
    """Which of the ordered sets are linked with the probe."""
    return list(Tree(sets).linked(probe, probe_n, sizes, percent))


class _Roots:
    """Union-find over the classes of one tile."""

    def __init__(self, roots: list[int]):
        self.up = {r: r for r in roots}
        self.own = roots

    def find(self, i: int) -> int:
        r = self.own[i]
        while self.up[r] != r:
            self.up[r] = self.up[self.up[r]]
            r = self.up[r]
        return r

    def join(self, i: int, j: int) -> None:
        self.up[self.find(i)] = self.find(j)


def _tile(percent: int):
    """Links between the two sides of each tile that join different components: every probe walks
    the tree of the other side, past the sets it is already connected with."""
    def run(table: pa.Table) -> pa.Table:
        a, b = [], []
        if table.num_rows:
            rows = table.to_pylist()
            tiles: dict = {}
            for r in rows:
                tiles.setdefault((r["cluster"], r["i"], r["j"]), []).append(r)
            for (_, i, j), some in tiles.items():
                sets = [unpack(r["tokens"], np.uint64) for r in some]
                sizes, roots = [r["n"] for r in some], _Roots([r["root"] for r in some])
                if len({roots.find(k) for k in range(len(some))}) < 2:
                    continue
                sides = [[k for k, r in enumerate(some) if r["chunk"] == c] for c in (i, j)]
                tree = Tree([sets[k] for k in sides[1]])
                right_sizes = [sizes[k] for k in sides[1]]
                for x in sides[0]:
                    low, high = -(-percent * sizes[x] // 100), 100 * sizes[x] // percent

                    def wanted(y, x=x, low=low, high=high):
                        return low <= right_sizes[y] <= high and roots.find(x) != roots.find(sides[1][y])

                    for y in tree.linked(sets[x], sizes[x], right_sizes, percent, wanted):
                        k = sides[1][y]
                        roots.join(x, k)
                        a.append(np.array([some[x]["cls"]])), b.append(np.array([some[k]["cls"]]))
        return _unique_pairs(a, b)
    return run


def across(postings: DataFrame, members: DataFrame, roots: DataFrame, parts: int, percent: int) -> DataFrame:
    """Links that join different components of ``roots``: all that are missing.

    Lists that still hold several components form clusters.  A cluster's members are cut into
    chunks of ``TILE`` or so, and each pair of chunks is a tile of its own, so that no task holds a cluster
    whatever its size; candidate pairs are never rows.  Chunks of one large component have no
    tile together: a group of near copies costs its members times the few that are not connected with it."""
    at = postings.mapInArrow(_who, "part long, node long").distinct().join(roots, "node").select("part", "node", "root")
    open_, _ = written(postings.groupBy("part").cogroup(at.groupBy("part")).applyInArrow(_open_lists, "a long, b long").distinct(), "open")
    clusters = connected(open_).select(F.col("node").alias("cls"), F.col("root").alias("cluster"))
    own = clusters.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left") \
        .select("cls", "cluster", F.coalesce("root", "cls").alias("root"))
    # a component of TILE members or more has chunks of its own, which need no tile with each other; the rest
    # of a cluster shares chunks.  So a large component meets only what is not in it.
    sizes = own.groupBy("cluster", "root").agg(F.count("*").alias("n"))
    large = F.when(F.col("n") >= TILE, F.col("root"))
    groups = sizes.groupBy("cluster", large.alias("big")).agg(F.ceil(F.sum("n") / TILE).cast("int").alias("chunks"))
    order = W.partitionBy("cluster").orderBy("big")             # one row a large component
    groups = groups.select("*", (F.sum("chunks").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("chunks")).alias("at"),
                           F.sum("chunks").over(W.partitionBy("cluster")).alias("total"))
    held = own.join(sizes.select("cluster", "root", large.alias("big")), ["cluster", "root"]) \
        .join(groups.withColumnsRenamed({"cluster": "_c", "big": "_b"}), (F.col("cluster") == F.col("_c")) & F.col("big").eqNullSafe(F.col("_b"))) \
        .select("cls", "cluster", "root", "big", "at", "chunks", "total",
                (F.col("at") + F.pmod(F.xxhash64("cls"), F.col("chunks"))).cast("int").alias("chunk"))
    every = F.sequence(F.lit(0), F.col("total").cast("int") - 1)
    others = F.when(F.col("big").isNull(), every).otherwise(
        F.filter(every, lambda c: (c < F.col("at")) | (c >= F.col("at") + F.col("chunks"))))
    held = held.withColumn("other", F.explode(others)) \
        .withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")})
    tiles = held.withColumn("slot", F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(8 * parts)))
    full = tiles.join(members, "cls").select("slot", "cluster", "i", "j", "chunk", "cls", "root", "n", "tokens")
    return full.groupBy("slot").applyInArrow(_tile(percent), "a long, b long")


def _verify(percent: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        probes = {c: (n, t) for c, n, t in zip(*(right.column(k).to_pylist() for k in ("cls", "size", "own")))}
        if left.num_rows:
            probe = left.column("a").to_numpy()
            order = np.argsort(probe, kind="stable")
            left = left.take(pa.array(order))
            names, at = cuts(probe[order])
            for p, i, j in zip(names.tolist(), at[:-1].tolist(), at[1:].tolist()):
                if p in probes:
                    n, t = probes[p]
                    some = left.slice(i, j - i)
                    ids = some.column("b").to_numpy()
                    hits = tree_overlaps(unpack(t, np.uint64), n, [unpack(x.as_buffer(), np.uint64) for x in some.column("tokens")],
                                         some.column("n").to_pylist(), percent)
                    a.append(np.full(len(hits), p)), b.append(ids[hits])
        return _unique_pairs(a, b)
    return run


def verified(pairs: DataFrame, members: DataFrame, buckets: int, percent: int) -> DataFrame:
    """The linked pairs.  A probe with many candidates is copied to several buckets, each
    with ``PROBE_CHUNK`` candidates or so."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PROBE_CHUNK).cast("int").alias("chunks"))
    slot = lambda c: F.pmod(F.xxhash64("a") + c, F.lit(buckets)).alias("slot")
    left = pairs.join(counts, "a").join(members.withColumnRenamed("cls", "b"), "b") \
        .select(slot(F.pmod(F.xxhash64("b"), F.col("chunks"))), "a", "b", "n", "tokens")
    right = counts.join(members.withColumnRenamed("cls", "a"), "a") \
        .select(F.col("a").alias("cls"), F.col("n").alias("size"), F.col("tokens").alias("own"), F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.pmod(F.xxhash64("a") + c, F.lit(buckets))))).alias("slot"))
    return left.groupBy("slot").cogroup(right.groupBy("slot")).applyInArrow(_verify(percent), "a long, b long")


def classes(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n (set size), cls (fingerprint of the set) of every row."""
    return keyed_text(docs).mapInArrow(_sets(size), "doc_id long, n long, cls long")


def class_links(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Links between classes (a, b) that suffice for their components, and their roots:
    a frame of (node, root) over all linked classes."""
    spark = docs.sparkSession
    docs = keyed_text(docs).filter("doc_id is not null and text is not null")
    parts = parts_for(text_bytes(docs), SET_BYTES)
    sent = docs.mapInArrow(_send(parts, size), BLOCK_SQL)
    counted = sent.groupBy("part").applyInArrow(_count(parts), BLOCK_SQL)
    members, _ = written(counted.groupBy("part").applyInArrow(_assemble(percent), "cls long, n long, tokens binary"), "members")
    del sent, counted
    release(spark)
    postings, _ = written(members.mapInArrow(_postings(parts, percent), BLOCK_SQL), "postings")
    found = None
    for round_ in range(ROUNDS):
        pairs, _ = written(postings.groupBy("part").applyInArrow(_leaders(round_, percent), "a long, b long").distinct(), "pairs")
        got, _ = written(verified(pairs, members, parts, percent), "found")
        found = got if found is None else found.unionByName(got)
        release(spark)
    roots = connected(found)
    rest, _ = written(across(postings, members, roots, parts, percent), "found")
    return connected(rest.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).filter("a <> b")))


def _who(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, ids in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
            node = unpack(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), part)), pa.array(node)], ["part", "node"])


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable over links)."""
    sets, _ = written(classes(docs, size), "sets")
    roots = class_links(docs, size, percent).select(F.col("node").alias("cls"), "root")
    some = sets.filter("n > 0 and doc_id is not null")
    # rows that share a doc_id join their classes
    ids = some.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).filter("a <> b")
    if not ids.isEmpty():
        more = some.join(ids.select("doc_id", "a"), "doc_id").filter("a <> cls").select("a", F.col("cls").alias("b"))
        roots = connected(more.unionByName(roots.select(F.col("cls").alias("a"), F.col("root").alias("b")).filter("a <> b"))) \
            .withColumnRenamed("node", "cls")
    # one row a class and component, then the least document of each
    by_class = some.groupBy("cls").agg(F.min("doc_id").alias("least")).join(roots, "cls", "left") \
        .select("cls", "least", F.coalesce("root", "cls").alias("root"))
    by_root = by_class.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = by_class.join(by_root, "root").select("cls", "component_id")
    return sets.join(by_class, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each component: of the document that gives it its id.  If several rows with words have that
    doc_id, the one with the least hash of all its columns stays.  Rows without doc_id, and rows without
    words (which are linked with nothing), all stay."""
    name = next(n for i in range(len(docs.columns) + 1) if (n := f"_id{i}") not in docs.columns)
    found = near_duplicates(docs, **options).filter("n_shingles > 0 AND doc_id IS NOT NULL")
    worded = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    same = (F.col("doc_id").cast("long") == F.col(name)) & worded
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    kept = docs.join(gone, same, "left_anti")
    # ids that come several times: counted map-side, and seldom any
    repeated, _ = written(found.filter("doc_id = component_id").groupBy(F.col("doc_id").alias(name)).agg(F.count("*").alias("n"))
                          .filter("n > 1").select(name), "repeated-ids")
    if repeated.isEmpty():
        return kept
    hashed = F.xxhash64(*(F.col(f"`{c}`") for c, t in docs.dtypes if "map<" not in t))
    one = kept.join(repeated, same, "left_semi").groupBy(F.col("doc_id").alias(name)).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), hashed).alias("row"))
    return kept.join(repeated, same, "left_anti").unionByName(one.select("row.*"))
