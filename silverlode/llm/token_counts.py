"""Token counts by scanning flat token files for their separators.

A token file is a run of token ids with one end-of-document id after each document and no
index.  Here a file is a sequence of rows (file, block, tokens): ``BLOCK_TOKENS`` ids a
block, 16 or 32 bits each, cut without regard to documents.  A scan finds the separators of a
block with one vector comparison.  What crosses block borders is stitched by a prefix scan
over block summaries (tokens, separators, place of the last separator): within groups of
``GROUP`` blocks first, then over the groups, so that one huge file spreads over many tasks.

Cases: an empty or null document is a separator alone and counts 0; tokens after a file's last
separator are one unfinished document (``finished`` false); a file without separators is one
unfinished document; empty blocks and empty tables count nothing.  Ids must not equal the
separator within a document, which the writer ensures: texts are encoded as ordinary text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from silverlode.llm.arrays import sliced
from silverlode.llm.bpe import Codec
from silverlode.llm.shared import keyed_text
from silverlode.session import shared_dir

BLOCK_TOKENS = 1 << 16
GROUP = 1024
MANIFEST_IDS = 4096


def token_rows(docs: DataFrame, shared_vocabulary, separator: int, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Token files of the documents, one for each partition: rows of kind ``block``
    (file, at = block number, data = ids) and of kind ``ids`` (file, at = ordinal of the first,
    data = doc_ids as 64-bit numbers, with null as the least number) that name the documents in order."""
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, codec = TaskContext.get().partitionId(), Codec(shared_vocabulary.value)
        rest, block, names, ordinal = np.zeros(0, kind), 0, [], 0
        row = lambda k, at, a: pa.RecordBatch.from_arrays(
            [pa.array([k]), pa.array([file], pa.int64()), pa.array([at], pa.int64()), pa.array([a.tobytes()], pa.binary())],
            ["kind", "file", "at", "data"])
        for b in sliced(batches):
            parts = [rest]
            for ids in codec.encode(b.column(1).to_pylist()):
                parts.append(np.array([*ids, separator], kind))
            rest = np.concatenate(parts)
            while len(rest) >= block_tokens:
                yield row("block", block, rest[:block_tokens])
                rest, block = rest[block_tokens:], block + 1
            names += [-2**63 if i is None else i for i in b.column(0).to_pylist()]
            while len(names) >= MANIFEST_IDS:
                yield row("ids", ordinal, np.array(names[:MANIFEST_IDS], "<i8"))
                names, ordinal = names[MANIFEST_IDS:], ordinal + MANIFEST_IDS
        if len(rest):
            yield row("block", block, rest)
        if names:
            yield row("ids", ordinal, np.array(names, "<i8"))

    return keyed_text(docs).mapInArrow(run, "kind string, file long, at long, data binary")


def write_token_files(docs: DataFrame, path: str, shared_vocabulary, separator: int, width: int = 2,
                      block_tokens: int = BLOCK_TOKENS) -> None:
    token_rows(docs, shared_vocabulary, separator, width, block_tokens).write.partitionBy("kind").option("compression", "zstd").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """file, block, tokens of the files under ``path``."""
    rows = spark.read.schema("file long, at long, data binary, kind string").parquet(path)
    return rows.filter("kind = 'block'").select("file", F.col("at").alias("block"), F.col("data").alias("tokens"))


def read_raw_files(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of raw binary files (whole ids, little endian), each file read by one task:
    Spark's binary source holds a file of 2 GB at most."""
    step = width * block_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, data in zip(b.column(0).to_pylist(), b.column(1)):
                data = data.as_buffer()
                for k, at in enumerate(range(0, data.size, step)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file], pa.int64()), pa.array([k], pa.int64()), pa.array([data.slice(at, min(step, data.size - at)).to_pybytes()])],
                        ["file", "block", "tokens"])

    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file"), "content")
    return files.mapInArrow(run, "file long, block long, tokens binary")


def scan(blocks: DataFrame, separator: int, width: int = 2) -> DataFrame:
    """file, block, n_tokens, and the places of separators in each block."""
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, found = [], []
            for data in b.column(2):
                ids = np.frombuffer(data.as_buffer() if data.is_valid else b"", kind)
                n.append(len(ids))
                found.append(np.flatnonzero(ids == separator).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32()))],
                                             ["file", "block", "n_tokens", "places"])

    return blocks.select("file", "block", "tokens").mapInArrow(run, "file long, block long, n_tokens long, places array<int>")


def count_tokens(scanned: DataFrame) -> DataFrame:
    """file, ordinal, n_tokens, finished: one row a document, from ``scan``'s rows."""
    s = scanned.select("file", "block", F.floor(F.col("block") / GROUP).alias("group"), "n_tokens", F.size("places").cast("long").alias("n_sep"),
                       F.try_element_at("places", F.lit(-1)).alias("last"))
    inside = W.partitionBy("file", "group").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    near = s.select("*", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("t0"), F.coalesce(F.sum("n_sep").over(inside), F.lit(0)).alias("s0"))
    # ``last`` in tokens from the group's start
    near = near.withColumn("last", F.col("t0") + F.col("last")).withColumn("before", F.last("last", True).over(inside))
    groups = near.groupBy("file", "group").agg(F.sum("n_tokens").alias("gt"), F.sum("n_sep").alias("gs"), F.max("last").alias("gl"))
    over = W.partitionBy("file").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    groups = groups.select("file", "group", "gt", "gs", "gl", F.coalesce(F.sum("gt").over(over), F.lit(0)).alias("gt0"),
                           F.coalesce(F.sum("gs").over(over), F.lit(0)).alias("gs0"))
    groups = groups.withColumn("gbefore", F.coalesce(F.last(F.col("gt0") + F.col("gl"), True).over(over), F.lit(-1)))
    base = near.join(groups, ["file", "group"]).select(
        "file", "block", (F.col("gt0") + F.col("t0")).alias("t0"), (F.col("gs0") + F.col("s0")).alias("s0"),
        F.coalesce(F.col("gt0") + F.col("before"), F.col("gbefore")).alias("before"))
    placed = scanned.join(base, ["file", "block"]).filter(F.size("places") > 0)
    lengths = F.expr("""zip_with(places, concat(array(before - t0), transform(slice(places, 1, size(places) - 1), x -> bigint(x))),
                                 (x, y) -> x - y - 1)""")
    done = placed.select("file", "s0", F.posexplode(lengths).alias("k", "n_tokens")).select(
        "file", (F.col("s0") + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("finished"))
    ends = groups.groupBy("file").agg(F.sum("gt").alias("t"), F.sum("gs").alias("ordinal"), F.max(F.col("gt0") + F.col("gl")).alias("l"))
    open_ = ends.select("file", "ordinal", (F.col("t") - 1 - F.coalesce("l", F.lit(-1))).alias("n_tokens"), F.lit(False).alias("finished")) \
        .filter("n_tokens > 0")
    return done.unionByName(open_)


def document_counts(spark: SparkSession, path: str, separator: int, width: int = 2) -> DataFrame:
    """doc_id and n_tokens of the documents in files written by ``write_token_files``."""
    counts = count_tokens(scan(read_blocks(spark, path), separator, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, at, data in zip(*(b.column(i) for i in range(3))):
                ids = np.frombuffer(data.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), file.as_py())), pa.array(at.as_py() + np.arange(len(ids))), pa.array(ids, mask=ids == -2**63)],
                    ["file", "ordinal", "doc_id"])

    rows = spark.read.schema("file long, at long, data binary, kind string").parquet(path)
    names = rows.filter("kind = 'ids'").select("file", "at", "data").mapInArrow(run, "file long, ordinal long, doc_id long")
    return names.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")


def measure(docs: DataFrame, shared_vocabulary, separator: int) -> DataFrame:
    """Write the documents as token files in the shared folder and count them by a scan."""
    path = shared_dir(docs.sparkSession, "tokens")
    write_token_files(docs, path, shared_vocabulary, separator)
    return document_counts(docs.sparkSession, path, separator)
