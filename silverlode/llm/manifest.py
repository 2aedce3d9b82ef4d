"""A Merkle manifest of a dataset, by slot pivots.

A row's leaf is the hash of its fields.  The leaves of a source, in order of doc_id, are the
lowest nodes; every ``FANOUT`` consecutive nodes (the last run may be shorter) become one, until one is
left: the source's subroot.  The subroots, by source, make the root in the same way.

Slot pivot: a conditional aggregate over the nodes of one parent spreads them into ``FANOUT`` columns.
All columns concatenated hash to the parent; the columns without a node's own slot are its siblings,
those before it and those after it apart, so that a proof can be folded.

``climb`` does this for ``RISE`` levels inside groups of ``FANOUT ** RISE`` consecutive nodes: rows are dealt
by (key, group) once, and the pivots of all these levels are windows over what a task already has. One row of
each group goes on to the next round, so rounds shrink by that factor, and the upper
part of the paths comes back by one join on (key, group).  A source with a third of all rows is many groups.

Order: rows are placed by ranges of (source, doc_id, leaf) (``ranks.placed``), so no task holds a whole source.

Cases: null fields count as ``-`` (lengths tell an empty text from it); null sources come first, null ids
come first in their source; rows that share an id are ordered by leaf, and rows that agree
in all fields have neighbouring places; an empty table has no rows; columns other than the five are not covered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverlode.llm.ranks import placed
from silverlode.llm.shared import forget, written

FANOUT = 3
#: Levels climbed in one round.
RISE = 5
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_STEP = "array<struct<before:string,after:string>>"


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(fields: list[Column]) -> Column:
    """The hash of a row: each field is ``-`` or its length in bytes, a colon and its value."""
    return F.sha2(F.concat(*(_field(c) for c in fields)).cast("binary"), 256)


def climb(nodes: DataFrame, rise: int = RISE) -> tuple[DataFrame, list[str]]:
    """``nodes`` (key, pos, count, digest) with ``path`` (the siblings before and after, level by level) and ``top``.

    ``count`` is how many nodes the key has; ``pos`` counts from 0.  Also returns the paths of tables behind it."""
    size = FANOUT ** rise
    rows = nodes.withColumn("group", F.expr(f"pos div {size}")).withColumns({
        "_at": F.col("pos"), "_left": F.col("count"), "_node": F.col("digest"), "path": F.expr(f"cast(array() AS {_STEP})")})
    for _ in range(rise):
        parent = Window.partitionBy("key", "group", "_up")
        rows = rows.withColumn("_up", F.expr(f"_at div {FANOUT}"))
        slots = {f"_c{k}": F.coalesce(F.max(F.when(F.col("_at") % FANOUT == k, F.col("_node"))).over(parent), F.lit("")) for k in range(FANOUT)}
        rows = rows.withColumns(slots)
        open_ = F.col("_left") > 1
        side = lambda own: F.concat(*(F.when(own(F.col("_at") % FANOUT, k), F.col(f"_c{k}")).otherwise("") for k in range(FANOUT)))
        step = F.struct(side(lambda at, k: at > k).alias("before"), side(lambda at, k: at < k).alias("after"))
        rows = rows.withColumns({
            "path": F.when(open_, F.concat("path", F.array(step))).otherwise(F.col("path")),
            "_node": F.when(open_, F.sha2(F.concat(*(F.col(f"_c{k}") for k in range(FANOUT))).cast("binary"), 256)).otherwise(F.col("_node")),
            "_at": F.col("_up"), "_left": F.expr(f"(_left + {FANOUT - 1}) div {FANOUT}"),
        }).drop(*slots)
    rows = rows.drop("_up", "_at")
    done, path = written(rows, "manifest-nodes")
    paths = [path]
    if done.filter("_left > 1").isEmpty():
        return done.withColumnRenamed("_node", "top").drop("group", "_left"), paths
    upper = done.filter(F.expr(f"pos % {size} = 0")).select("key", F.col("group").alias("pos"), F.col("_left").alias("count"), F.col("_node").alias("digest"))
    above, more = climb(upper, rise)
    above = above.select(F.col("key").alias("_key"), F.col("pos").alias("_pos"), F.col("path").alias("_path"), "top")
    joined = done.join(above, F.col("key").eqNullSafe(F.col("_key")) & (F.col("group") == F.col("_pos")))
    return joined.withColumn("path", F.concat("path", "_path")).drop("_key", "_pos", "_path", "group", "_left", "_node"), paths + more


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest and its siblings lead to."""
    return F.aggregate(path, digest, lambda a, s: F.sha2(F.concat(s["before"], a, s["after"]).cast("binary"), 256))


def manifest(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """doc_id, source, leaf, seen, subroot, root, path for every row of ``docs``, and the paths of tables behind it.

    ``seen`` is the leaf of the row as it is found now: ``docs`` may bring it as a column ``_seen``."""
    seen = F.col("_seen") if "_seen" in docs.columns else None
    cells = [F.col(f"`{c}`") for c in FIELDS]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf(cells).alias("leaf"),
                       *([seen.alias("seen")] if seen is not None else []))
    if seen is None:
        rows = rows.withColumn("seen", F.col("leaf"))
    rows = rows.groupBy("doc_id", "source", "leaf", "seen").agg(F.count("*").alias("copies"))
    located, path = placed(rows, ["source"], ["doc_id", "leaf", "seen"], "copies", "manifest-rows")
    paths = [path]
    sizes = located.groupBy("source").agg(F.sum("copies").alias("count"))
    sources, path = placed(sizes.withColumn("one", F.lit(1).cast("long")), [], ["source"], "one", "manifest-sources")
    paths.append(path)
    sources, path = written(sources.select("source", "count", F.col("pos").alias("sid")), "manifest-sizes")
    paths.append(path)
    leaves = located.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    leaves = leaves.withColumn("_copy", F.explode(F.expr("sequence(0L, copies - 1)"))).withColumn("pos", F.col("pos") + F.col("_copy"))
    done, more = climb(leaves.select("doc_id", "source", "seen", F.col("sid").alias("key"), "pos", "count", F.col("leaf").alias("digest")))
    paths += more
    # the subroots are the leaves of the last tree
    tops = done.filter("pos = 0").select(F.lit(0).cast("long").alias("key"), F.col("key").alias("pos"),
                                         F.lit(sources.count()).cast("long").alias("count"), F.col("top").alias("digest"))
    upper, more = climb(tops)
    upper = upper.select(F.col("pos").alias("_sid"), F.col("path").alias("_path"), F.col("top").alias("root"))
    paths += more
    out = done.join(upper, F.col("key") == F.col("_sid")).select(
        "doc_id", "source", F.col("digest").alias("leaf"), "seen", F.col("top").alias("subroot"), "root", F.concat("path", "_path").alias("path"))
    return out, paths


def proof_hash(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def verify(docs: DataFrame, tampered: Column, text: Column) -> DataFrame:
    """The manifest of ``docs``, held against rows of which those ``tampered`` now have ``text``.

    doc_id, leaf, subroot, root and proof_sha256 are those of the untouched rows; folded_root comes from the row as it
    is now and the original siblings; verified tells whether it is the root."""
    now = [F.when(tampered, text).otherwise(F.col("text")) if c == "text" else F.col(f"`{c}`") for c in FIELDS]
    rows, paths = manifest(docs.select(*(F.col(f"`{c}`") for c in FIELDS), leaf(now).alias("_seen")))
    folded = rows.withColumn("folded_root", fold(F.col("seen"), F.col("path")))
    out, _ = written(folded.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), "folded_root",
                                   (F.col("folded_root") == F.col("root")).alias("verified")), "manifest")
    forget(docs.sparkSession, *paths)
    return out


def audit(docs: DataFrame, every: int = 2) -> DataFrame:
    """A drill: rows whose id's crc32 ``every`` divides lose the line breaks of their texts (null ids are left alone)."""
    struck = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % every == 0, F.lit(False))
    return verify(docs, struck, F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit("")))
