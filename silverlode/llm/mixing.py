"""Mixing sources to target weights over a multivariate-hypergeometric splitting tree.

1. Sizes.  A document's size is its number of words.  Sources share ``share`` times the total by
   weight; none gets more than ``cap`` times its own size, and what it cannot take is
   shared by the others (the water level is found by a few aggregates over the table of sources).
2. Blocks.  A hash of (id, text, copy) deals the documents of a source into blocks of some
   ``block_words`` words.  A block's place in an epoch is an affine permutation of its number.
   A source gives its whole epochs, and of the last one the first blocks until its
   target is met; the block at the border is taken in part, its last document up to the word
   that meets the target.  So each source has an exact quota of block draws.
3. Tree.  The root has the quotas of all sources and all output shards.  A node gives its left
   half of the shards their number of blocks: how many of each source is a multivariate
   hypergeometric draw, made source by source (each a hypergeometric draw from what is left),
   and the right half keeps the rest.  The leaves hold exact quotas of every source for each
   shard, and where in the source's permuted sequence they begin: the draws of different shards
   are disjoint, and nothing is drawn twice but by epochs.
4. Shards.  ``mix`` gathers each shard's documents and shuffles them inside it.

Everything is DataFrame and SQL expressions.  Only numbers cross tasks: narrow rows of documents,
one row for each block, one row for each node of the tree.  Running sums over blocks are taken span by
span, so a source with a third of all rows is spread like the others.  A node holds one number
a source.  All randomness is hashed from the seed and the values of the row: reruns, retried tasks and other
partitionings give the same mix.

Cases: null, empty or blank texts have no words and are never drawn; a null source is a source, the last;
rows that agree in id, source and text are copies and counted, so they may differ in
what is taken of each; without any words all targets are 0; ``share`` above ``cap`` takes all that ``cap``
allows; other columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverlode.llm.ranks import placed, running
from silverlode.llm.shared import forget, written

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2
BLOCK_WORDS = 1 << 14
SHARD_BLOCKS = 64
SEED = "mix"
WORD = r"[^\\x20\\x09-\\x0D]++"
# Primes below 2^31, multipliers of the permutations (prime to every number of blocks).
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497)


def _u32(text: str) -> str:
    """A number of 32 bits from a text, the same in every engine that has MD5."""
    return f"cast(conv(substring(md5({text}), 1, 8), 16, 10) AS bigint)"


def _let(name: str, value: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def items(docs: DataFrame) -> DataFrame:
    """doc_id, source, digest of the text, size, and how many rows agree in these."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.md5(F.coalesce(text, F.lit(""))).alias("digest"),
        F.coalesce(F.regexp_count(text, F.expr(f"'{WORD}'")), F.lit(0)).cast("long").alias("size"),
    ).groupBy("doc_id", "source", "digest", "size").agg(F.count("*").alias("copies"))


def targets(sources: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sources`` (size, weight, ...) with ``target``.

    The level starts as if no source were capped; each round caps the sources above it and
    raises it for the others, until no more are capped.  One aggregate of three numbers a round."""
    total = sources.agg(F.sum("size")).first()[0] or 0
    level, capped = 0.0, -1
    above = "0 > 1"
    while True:
        n, full, weight = sources.agg(
            F.count(F.when(F.expr(above), 1)), F.coalesce(F.sum(F.when(F.expr(above), F.col("size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(F.expr(above), F.lit(0)).otherwise(F.col("weight"))), F.lit(0))).first()
        if n == capped or not weight:
            break
        capped, level = n, (share * total - cap * full) / weight
        above = f"weight * {level!r}D > {cap} * size"
    return sources.withColumn("target", F.expr(f"CASE WHEN {above} THEN cast({cap} * size AS double) ELSE weight * {level!r}D END"))


# -- tree ------------------------------------------------------------------------

# Logarithms of the first factorials; Stirling's series beyond them.
_LF = "array(" + ", ".join(f"{math.lgamma(i + 1)!r}D" for i in range(20)) + ")"


def _lf(x: str) -> str:
    return _let("z", f"cast({x} AS double)", f"CASE WHEN z < 20 THEN get({_LF}, int(z)) ELSE z * ln(z) - z + 0.5D * ln({2 * math.pi!r}D * z) "
                "+ 1D / (12 * z) - 1D / (360 * z * z * z) END")


def hypergeometric(u: str, total: str, good: str, drawn: str) -> str:
    """SQL for how many of ``drawn`` items, taken without replacement from ``total``, are among its
    ``good`` ones, by inversion of the uniform number ``u``.

    Values are tried outwards from the mode, whose probability comes from log factorials and that of
    its neighbours from the ratios; twelve standard deviations are more than doubles can tell."""
    step = """CASE WHEN a.k IS NOT NULL THEN a ELSE {inner} END"""
    up = "CASE WHEN h.m + i <= h.hi THEN a.up * (h.g - h.m - i + 1) * (h.d - h.m - i + 1) / ((h.m + i) * (h.t - h.g - h.d + h.m + i)) ELSE 0D END"
    down = "CASE WHEN h.m - i >= h.lo THEN a.down * (h.m - i + 1) * (h.t - h.g - h.d + h.m - i + 1) / ((h.g - h.m + i) * (h.d - h.m + i)) ELSE 0D END"
    inner = _let("p", f"named_struct('up', {up}, 'down', {down})",
                 "named_struct('u', a.u - p.up - p.down, 'up', p.up, 'down', p.down, 'k', "
                 "CASE WHEN a.u < p.up THEN h.m + i WHEN a.u < p.up + p.down THEN h.m - i ELSE cast(NULL AS bigint) END)")
    at_mode = " + ".join([_lf("b.g"), _lf("b.t - b.g"), _lf("b.d"), _lf("b.t - b.d")]) + " - " + " - ".join(
        [_lf("b.t"), _lf("b.m"), _lf("b.g - b.m"), _lf("b.d - b.m"), _lf("b.t - b.g - b.d + b.m")])
    steps = "least(h.hi - h.lo, cast(ceil(12 * sqrt(1D * h.d * h.g / h.t * (h.t - h.g) / h.t * (h.t - h.d) / greatest(h.t - 1, 1) + 1)) + 8 AS bigint))"
    walk = (f"aggregate(sequence(1L, greatest({steps}, 1L)), named_struct('u', h.u - h.p, 'up', h.p, 'down', h.p, "
            f"'k', CASE WHEN h.u < h.p THEN h.m ELSE cast(NULL AS bigint) END), (a, i) -> {step.format(inner=inner)}, a -> coalesce(a.k, h.m))")
    mode = "least(least(x.g, x.d), greatest(greatest(0L, x.d - x.t + x.g), cast(floor((x.d + 1D) * (x.g + 1D) / (x.t + 2D)) AS bigint)))"
    return _let("x", f"named_struct('u', {u}, 't', {total}, 'g', {good}, 'd', {drawn})",
                _let("b", f"named_struct('u', x.u, 't', x.t, 'g', x.g, 'd', x.d, 'lo', greatest(0L, x.d - x.t + x.g), 'hi', least(x.g, x.d), 'm', {mode})",
                     f"CASE WHEN b.lo = b.hi THEN b.lo ELSE "
                     + _let("h", f"named_struct('u', b.u, 't', b.t, 'g', b.g, 'd', b.d, 'lo', b.lo, 'hi', b.hi, 'm', b.m, 'p', exp({at_mode}))", walk) + " END"))


def split(quotas: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """shard, sid, first, quota from ``quotas`` (sid, quota): how many draws of each source a shard
    gets, and from which on.  Shards differ by one draw at most.

    One row a node; each level splits all its nodes at once, a node's row holding one number a source."""
    root = quotas.filter("quota > 0").agg(F.array_sort(F.collect_list(F.struct("sid", F.lit(0).cast("long").alias("first"), F.col("quota").alias("q")))).alias("s"),
                                          F.coalesce(F.sum("quota"), F.lit(0)).alias("all"))
    nodes = root.select(F.lit(1).cast("long").alias("node"), F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("width"),
                        F.col("all").alias("n"), "all", "s")
    seats = lambda x: f"(({x}) * (all div {shards}) + least({x}, all % {shards}))"
    u = f"pmod(xxhash64('{seed}', node, q.sid), {1 << 53}L) / {float(1 << 53)!r}D"
    draw = hypergeometric(u, "a.n", "q.q", "a.left")
    fold = (f"aggregate(s, named_struct('left', half, 'n', n, 'out', cast(array() AS array<bigint>)), (a, q) -> "
            + _let("k", draw, "named_struct('left', a.left - k, 'n', a.n - q.q, 'out', concat(a.out, array(k)))") + ", a -> a.out)")
    for level in range(max(0, shards - 1).bit_length()):
        if level % 6 == 5:                      # a node's children would stay in its task
            nodes = nodes.repartition("node")
        mid = "(width + 1) div 2"
        cut = nodes.withColumn("half", F.expr(f"{seats(f'low + {mid}')} - {seats('low')}"))
        cut = cut.withColumn("l", F.expr(f"CASE WHEN width > 1 THEN {fold} END"))
        left = (f"named_struct('node', 2 * node, 'low', low, 'width', {mid}, 'n', half, 's', "
                "zip_with(s, l, (x, k) -> named_struct('sid', x.sid, 'first', x.first, 'q', k)))")
        right = (f"named_struct('node', 2 * node + 1, 'low', low + {mid}, 'width', width - {mid}, 'n', n - half, 's', "
                 "zip_with(s, l, (x, k) -> named_struct('sid', x.sid, 'first', x.first + k, 'q', x.q - k)))")
        stay = "named_struct('node', 2 * node, 'low', low, 'width', width, 'n', n, 's', s)"
        nodes = cut.select("all", F.expr(f"explode(CASE WHEN width > 1 THEN array({left}, {right}) ELSE array({stay}) END)").alias("c")) \
            .select("c.node", "c.low", "c.width", "c.n", "all", "c.s")
    return nodes.select(F.col("low").alias("shard"), F.explode("s").alias("q")).filter("q.q > 0") \
        .select("shard", "q.sid", F.col("q.first").alias("first"), F.col("q.q").alias("quota"))


# -- plan ------------------------------------------------------------------------

class Mix:
    """The plan of a mix: ``sources`` (sid, source, size, weight, target, ...), ``rows`` (sid, doc_id,
    digest, copy, size, block, u) and ``draws`` (sid, block, draw, shard, words, whole)."""

    def __init__(self, docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP,
                 block_words: int = BLOCK_WORDS, shards: int | None = None, seed: str = SEED):
        spark, self.paths = docs.sparkSession, []
        found, path = written(items(docs), "mix-items")
        self.paths.append(path)
        sums = found.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("size"),
                                           F.sum(F.when(F.col("size") > 0, F.col("copies")).otherwise(0)).alias("worded"))
        # by code point, null last
        ranked, path = placed(sums.withColumn("one", F.lit(1).cast("long")).withColumn("last", F.col("source").isNull()), [], ["last", "source"], "one", "mix-sources")
        self.paths.append(path)
        weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("pos") % len(weights) + 1).cast("int"))
        ranked, path = written(ranked.select(F.col("pos").alias("sid"), "source", "size", "worded", weight.alias("weight")), "mix-weights")
        self.paths.append(path)
        known = targets(ranked, share, cap).withColumn("take", F.floor("target"))
        known = known.withColumns({"epochs": F.expr("CASE WHEN size > 0 THEN take div size ELSE 0L END"),
                                   "rest": F.expr("CASE WHEN size > 0 THEN take % size ELSE 0L END"),
                                   "blocks": F.expr(f"greatest(1L, least(worded, cast(ceil(size / {block_words}D) AS bigint)))")})
        self.sources, path = written(known, "mix-targets")
        self.paths.append(path)
        # documents into blocks
        s = self.sources.select("sid", F.col("source").alias("_source"), "blocks")
        rows = found.join(s, F.col("source").eqNullSafe(F.col("_source"))).select(
            "sid", "doc_id", "digest", "size", "blocks", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
        rows = rows.withColumn("u", F.expr(_u32(f"concat_ws(':', '{seed}', coalesce(cast(doc_id AS string), '-'), digest, copy)")))
        self.rows, path = written(rows.withColumn("block", F.expr("shiftright(u * blocks, 32)")).drop("blocks"), "mix-rows")
        self.paths.append(path)
        # draws of blocks
        per = self.rows.filter("size > 0").groupBy("sid", "block").agg(F.sum("size").alias("words"))
        per = per.join(self.sources.select("sid", "blocks", "epochs", "rest"), "sid")
        per = per.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), "epochs")))
        times = f"get(array({', '.join(f'{p}L' for p in PRIMES)}), int({_u32(f"concat_ws(':', '{seed}', 'times', sid, epoch)")} % {len(PRIMES)}))"
        plus = f"{_u32(f"concat_ws(':', '{seed}', 'plus', sid, epoch)")} % blocks"
        per = per.withColumn("place", F.expr(f"({times} * block + {plus}) % blocks"))
        whole = per.filter("epoch < epochs").select("sid", "block", (F.col("epoch") * F.col("blocks") + F.col("place")).alias("draw"),
                                                    "words", F.lit(True).alias("whole"))
        last = running(per.filter("epoch = epochs AND rest > 0"), "sid", "place", "words").filter("before < rest")
        last = last.select("sid", "block", (F.col("epoch") * F.col("blocks") + F.col("place")).alias("draw"),
                           F.least("words", F.col("rest") - F.col("before")).alias("words"), F.expr("rest - before >= words").alias("whole"))
        drawn, path = written(whole.unionByName(last), "mix-draws")
        self.paths.append(path)
        quotas, path = written(drawn.groupBy("sid").agg((F.max("draw") + 1).alias("quota")), "mix-quotas")
        self.paths.append(path)
        n = quotas.agg(F.sum("quota")).first()[0] or 0
        self.shards = shards or max(1, -(-n // SHARD_BLOCKS))
        leaves, path = written(split(quotas, self.shards, seed), "mix-tree")
        self.paths.append(path)
        seats = leaves.select("shard", "sid", F.explode(F.expr("sequence(first, first + quota - 1)")).alias("draw"))
        self.draws, path = written(drawn.join(seats, ["sid", "draw"]), "mix-shards")
        self.paths.append(path)
        self.seed, self.spark = seed, spark

    def parts(self) -> DataFrame:
        """sid, doc_id, digest, copy, size, u, draw, shard, words: what each draw takes of each document."""
        whole = self.rows.join(self.draws.filter("whole").drop("words", "whole"), ["sid", "block"]).withColumn("words", F.col("size"))
        border = self.draws.filter("NOT whole").withColumnRenamed("words", "part").drop("whole")   # one a source
        inside = Window.partitionBy("sid", "block").orderBy("u", "digest", "doc_id", "copy").rowsBetween(Window.unboundedPreceding, -1)
        cut = self.rows.filter("size > 0").join(border, ["sid", "block"]).withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        cut = cut.filter("before < part").withColumn("words", F.least("size", F.col("part") - F.col("before"))).drop("before", "part")
        return whole.unionByName(cut).drop("block").filter("words > 0")

    def measures(self) -> DataFrame:
        """One row a document: doc_id, size, source_size, target, taken."""
        keys = ["sid", "doc_id", "digest", "copy", "size"]
        parts = self.parts().select(*keys, "words")
        none = self.rows.select(*keys, F.lit(0).cast("long").alias("words"))
        taken = none.unionByName(parts).groupBy(*keys).agg(F.sum("words").alias("taken"))
        known = self.sources.select("sid", F.col("size").alias("source_size"), "target")
        return taken.join(known, "sid").select("doc_id", "size", "source_size", "target", "taken")


def measure(docs: DataFrame, **options) -> DataFrame:
    """The measures of a mix, written once; the tables of its plan are removed."""
    plan = Mix(docs, **options)
    out, _ = written(plan.measures(), "mix-measures")
    forget(plan.spark, *plan.paths)
    return out


def mix(docs: DataFrame, plan: Mix) -> DataFrame:
    """shard, place, doc_id, source, epoch, words, text: the corpus as ``plan`` (made of the same
    documents) mixes it, a shard's rows in one partition in shuffled order.  A text taken in part
    is its first words, joined by spaces.  Remove ``plan.paths`` once the rows are stored."""
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("source").cast("string").alias("_source"),
                        F.col("text").cast("string").alias("text"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_digest"))
    texts = texts.dropDuplicates(["_id", "_source", "_digest"])
    parts = plan.parts().join(plan.sources.select("sid", "source", "blocks"), "sid")
    found = parts.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("digest") == F.col("_digest")))
    first = f"array_join(slice(regexp_extract_all(text, '{WORD}', 0), 1, int(words)), ' ')"
    out = found.select(
        "shard", F.expr(f"xxhash64('{plan.seed}', shard, draw, u, copy)").alias("place"), "doc_id", "source",
        F.expr("draw div blocks").alias("epoch"), "words", F.expr(f"CASE WHEN words < size THEN {first} ELSE text END").alias("text"))
    return out.repartition("shard").sortWithinPartitions("shard", "place", "doc_id")
