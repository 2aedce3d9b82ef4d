"""Session defaults and the shared work area.

Nothing in the library creates a session on its own: every function takes one.
``open_session`` is for scripts and tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Adaptive execution carries the physical tuning: partition coalescing, runtime
# broadcast (size-checked) and splitting of skewed join partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Fixed value: compression of the files this library writes.
CODEC = "zstd"


def open_session(
    app_name: str = "silverlode",
    master: str | None = None,
    options: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session.  Storage credentials, catalogs and cluster
    sizes are deployment settings and come in through ``options``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(options or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory name inside the work area every executor can reach.

    The cluster names that area in ``spark.checkpoint.dir``.  Only a local
    session without the setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete one directory this library wrote, through the path's own file system."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Stored size of a directory tree, from file metadata only."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(target).getLength())


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a directory (none if it does not exist)."""
    if not path_exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in fs.listStatus(target)]


def publish_names(spark: SparkSession, path: str, names: list[str]) -> None:
    """Make a directory that lists names (as empty directories), all at once by a rename."""
    jvm = spark._jvm
    target, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}-draft")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(draft, True)
    for name in names:
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(draft, name))
    fs.rename(draft, target)


class Stage:
    """A frame written once to the shared area so that several sinks can read it.

    Parquet on shared storage survives executor loss (the readers never recompute
    the joins and windows above it), and a partition column lets each sink read
    only its own share.
    """

    def __init__(
        self, df: DataFrame, purpose: str, partition_by: list[str] | None = None,
        metrics: dict[str, Column] | None = None,
    ):
        self._spark = df.sparkSession
        self.path = shared_dir(self._spark, purpose)
        self._schema = df.schema
        seen = Observation()
        watched = df.observe(seen, *[c.alias(n) for n, c in metrics.items()]) if metrics else df
        writer = watched.write.option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path)
        self.metrics: dict = dict(seen.get) if metrics else {}

    def read(self) -> DataFrame:
        return self._spark.read.schema(self._schema).parquet(self.path)

    def __enter__(self) -> "Stage":
        return self

    def __exit__(self, *exc) -> None:
        remove_path(self._spark, self.path)
