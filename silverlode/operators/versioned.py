"""Tables with versions, kept as plain Parquet directories and a commit log.

Layout under the table path::

    data/<directory>/...parquet     rows written by one commit
    log/...parquet                  one small file per commit

A commit writes its data directory first and publishes a log row last; readers
only look at directories the log names, so a failed attempt is invisible.  One
writer per table at a time is assumed.

Commits append rows, replace everything (``overwrite``), upsert on the table's key
or point back to an earlier version (``restore``).  An upsert writes the batch
only -- the table is not rewritten; readers let the newest upserted row of a key
win, and ``compact`` folds the pile.  Compaction changes no row: each keeps the
number of the commit that brought it in ``_origin``, so followers never take a
rewritten row for a new one.

The log is a frame.  One aggregate finds the last commit, the schema and the last full
write; of the commits themselves only those that a version is made of reach the driver.
A schema is stored with the commit that changes it, not with every row.  The value of a column
added later stands in the schema too, where Spark's Parquet reader finds it for files without that column.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators.partitioned import PartitionedTable
from silverlode.schemas import struct
from silverlode.session import CODEC, list_names, path_bytes, remove_path

LOG_SCHEMA = struct(
    "version bigint, committed_at timestamp, operation string, kind string, "
    "directory string, refers_to bigint, row_count bigint, metrics string, "
    "schema string, partition_by array<string>, keys array<string>, "
    "writer string, batch bigint"
)

APPEND, OVERWRITE, UPSERT, RESTORE, EXPIRE, WIDEN = "append", "overwrite", "upsert", "restore", "expire", "widen"
DELETE, INSERT = "delete", "insert"
OPTIMIZE = "OPTIMIZE"

# Fixed value: upper end of the file size range wanted after compaction (bytes).
TARGET_FILE_BYTES = 512 * 1024 * 1024

# Fixed value: field metadata by which Spark fills a column that a file does not have.
EXISTS_DEFAULT = "EXISTS_DEFAULT"

_VERSION = "_version"
_ORIGIN = "_origin"


class VersionNotFound(LookupError):
    """No such version, or it has been expired."""


@dataclass
class Commit:
    version: int
    committed_at: dt.datetime
    operation: str
    kind: str
    directory: str | None = None
    refers_to: int | None = None
    row_count: int | None = None
    metrics: str | None = None
    schema: str | None = None
    partition_by: list[str] = field(default_factory=list)
    keys: list[str] = field(default_factory=list)
    writer: str | None = None
    batch: int | None = None


@dataclass
class State:
    """What the log says about a version: its commit, its schema, the last full write
    it rests on, the oldest version kept, and the last batch of a writer."""

    last: Commit | None
    struct: T.StructType | None
    start: int | None
    floor: int | None
    batch: int | None


def _merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Union of two schemas by column name; a changed type is an error."""
    known = {f.name: f for f in old}
    for f in new:
        if f.name in known and known[f.name].dataType != f.dataType:
            raise TypeError(
                f"column {f.name} is {known[f.name].dataType.simpleString()} in the table "
                f"and {f.dataType.simpleString()} in the new rows")
    return T.StructType([*old.fields, *[f for f in new if f.name not in known]])


def resolve_upserts(rows: DataFrame, upserts: DataFrame, keys: list[str]) -> DataFrame:
    """Drop the rows that a later upsert replaced.

    ``rows`` is everything a version is made of, with ``_version``; ``upserts`` is
    the part of it that was upserted.  A row goes when its key was upserted in a
    later version.  NULL keys match nothing and stay.

    The newest upsert per key is a map-side combined maximum over the key columns
    alone.  The anti join broadcasts it if its measured size allows, so a table
    with few pending upserts is read without a shuffle.
    """
    newest = (
        upserts.dropna(subset=keys).groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        .agg(F.max(_VERSION).alias("_upserted_in"))
    )
    replaced = F.col(_VERSION) < F.col("_upserted_in")
    for i, k in enumerate(keys):
        replaced = replaced & (F.col(k) == F.col(f"_k{i}"))
    return rows.join(newest, replaced, "left_anti")


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- log ------------------------------------------------------------------

    @property
    def _log_path(self) -> str:
        return f"{self.path}/log"

    def _directory(self, name: str) -> str:
        return f"{self.path}/data/{name}"

    def exists(self) -> bool:
        """Whether a commit was published; success markers play no part."""
        return any(n.endswith(".parquet") for n in list_names(self.spark, self._log_path))

    def log(self) -> DataFrame:
        if not self.exists():
            raise VersionNotFound(f"no table at {self.path}")
        return self.spark.read.schema(LOG_SCHEMA).parquet(self._log_path)

    def _state(self, upto: int | None = None, writer: str | None = None) -> State:
        """One aggregate over the log, one row to the driver."""
        if not self.exists():
            return State(None, None, None, None, None)
        real = F.col("kind") != EXPIRE
        if upto is not None:
            real = real & (F.col("version") <= upto)
        version = F.when(real, F.col("version"))
        full = F.col("kind").isin(OVERWRITE, RESTORE)
        row = self.log().agg(
            F.max_by(F.struct(*LOG_SCHEMA.names), version).alias("last"),
            F.max_by("schema", F.when(F.col("schema").isNotNull(), version)).alias("schema"),
            F.max(F.when(full, version)).alias("start"),
            F.max(F.when(F.col("kind") == EXPIRE, F.col("version"))).alias("floor"),
            F.max(F.when(F.col("writer") == F.lit(writer), F.col("batch"))).alias("batch"),
        ).first()
        return State(
            Commit(**row.last.asDict()) if row.last else None,
            T.StructType.fromJson(json.loads(row.schema)) if row.schema else None,
            row.start, row.floor, row.batch)

    def _at(self, version: int | None) -> State:
        """The state as of a version that exists and is kept (default: the latest)."""
        state = self._state(version)
        if state.last is None and version is None:
            raise VersionNotFound(f"no table at {self.path}")
        if state.last is None or version is not None and state.last.version != version:
            raise VersionNotFound(f"version {version} does not exist")
        if state.floor is not None and state.last.version < state.floor:
            raise VersionNotFound(f"version {version} has been expired; {state.floor} is the oldest kept")
        return state

    def _between(self, first: int, last: int) -> list[Commit]:
        rows = self.log().where((F.col("kind") != EXPIRE) & F.col("version").between(first, last)).collect()
        return sorted((Commit(**r.asDict()) for r in rows), key=lambda c: c.version)

    def _all_commits(self) -> list[Commit]:
        return sorted((Commit(**r.asDict()) for r in self.log().collect()), key=lambda c: c.version)

    def _publish(self, commit: Commit) -> int:
        facts = {f.name: getattr(commit, f.name) for f in LOG_SCHEMA}
        moment = commit.committed_at.astimezone(dt.timezone.utc)
        facts["committed_at"] = moment.isoformat(timespec="microseconds")
        row = self.spark.range(1, numPartitions=1).select(
            F.inline(F.array(F.from_json(F.lit(json.dumps(facts)), LOG_SCHEMA))))
        row.write.mode("append").parquet(self._log_path)
        return commit.version

    def history(self) -> DataFrame:
        """One row per version, newest first."""
        return (
            self.log().where(F.col("kind") != EXPIRE)
            .select("version", "committed_at", "operation", "row_count", "metrics")
            .orderBy(F.col("version").desc())
        )

    def last_batch(self, writer: str) -> int | None:
        """The newest batch of a writer that is in the table."""
        return self._state(writer=writer).batch

    def commit_of(self, version: int) -> Commit:
        found = self._between(version, version)
        if not found:
            raise VersionNotFound(f"version {version} does not exist")
        return found[0]

    def schema_of(self, version: int) -> T.StructType:
        return self._at(version).struct

    def has_pending_upserts(self) -> bool:
        """Whether readers have to resolve upserts."""
        return any(c.kind == UPSERT for c in self._live(self._at(None)))

    def latest_version(self) -> int:
        return self._at(None).last.version

    def version_at(self, moment: dt.datetime) -> int:
        """The last version committed at or before a moment (session time zone)."""
        found = (
            self.log()
            .where((F.col("kind") != EXPIRE) & (F.col("committed_at") <= F.lit(moment).cast("timestamp")))
            .agg(F.max("version").alias("v")).first().v
        )
        if found is None:
            raise VersionNotFound(f"{self.path} has no version at or before {moment}")
        return found

    # -- reading --------------------------------------------------------------

    def _chain(self, state: State) -> list[Commit]:
        """The commits a version rests on, oldest first: back to the last full write,
        through a restore to what it points at."""
        found = self._between(state.start or 0, state.last.version)
        if found[0].kind == RESTORE:
            found = self._chain(self._state(found[0].refers_to)) + found
        return found

    def _live(self, state: State) -> list[Commit]:
        """The commits whose directories make up a version, oldest first."""
        return [c for c in self._chain(state) if c.directory]

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (default: the latest).  A table that is kept partition by
        partition has its present rows only."""
        if version is None and not self.exists() and (kept := PartitionedTable(self.spark, self.path)).exists():
            return kept.read()
        state = self._at(version)
        return self._assemble(self._live(state), state.struct)

    def read_since(self, after: int, upto: int) -> DataFrame | None:
        """Rows of version ``upto`` that came with commits later than ``after`` (None if
        no such commit is left).  Directories of earlier commits are not listed; of a
        compacted one only the rows that are later are taken, by their own number."""
        state = self._at(upto)
        live = [c for c in self._live(state) if c.version > after]
        if not live:
            return None
        return self._assemble(live, state.struct, versions=True).where(F.col(_VERSION) > after).drop(_VERSION)

    def read_at(self, moment: dt.datetime) -> DataFrame:
        return self.read(self.version_at(moment))

    def _assemble(self, live: list[Commit], schema: T.StructType, versions: bool = False) -> DataFrame:
        upserts = [c for c in live if c.kind == UPSERT]
        if not upserts:
            return self._scan(live, schema, versions)      # nothing to resolve: one plain scan
        # what came with the last upsert or later cannot have been replaced: a plain scan
        earlier, latest = ([c for c in live if (c.version < upserts[-1].version) == older] for older in (True, False))
        settled = self._scan(latest, schema, versions)
        if not earlier:
            return settled
        rows = resolve_upserts(
            self._scan(earlier, schema, versions=True),
            self._scan(upserts, schema, versions=True),
            upserts[-1].keys,
        )
        return rows.select(*schema.names, *([_VERSION] if versions else [])).unionByName(settled)

    def _scan(self, commits: list[Commit], schema: T.StructType, versions: bool = False) -> DataFrame:
        paths = [self._directory(c.directory) for c in commits]
        # The directory names are a partition column, so the version of a row comes
        # from its path and costs nothing to store or to filter on.  Compacted rows
        # carry their number themselves.
        extra = [T.StructField(_ORIGIN, T.LongType())] if versions else []
        full = T.StructType([*schema.fields, *extra, T.StructField("_commit", T.StringType())])
        df = (
            self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*paths)
        )
        if versions:
            number = F.substring_index(F.col("_commit"), "-", 1).cast("bigint")
            return df.withColumn(_VERSION, F.coalesce(_ORIGIN, number)).select(*schema.names, _VERSION)
        return df.select(*schema.names)

    def changes(self, after: int, upto: int | None = None) -> DataFrame:
        """What the commits after one version, up to another, did to the rows, with
        ``_version`` and ``_change``.

        Appended and upserted rows come as they were written (``append``, ``upsert``).
        A commit that replaces the table comes as the difference it made (``delete``,
        ``insert``).  Compaction changes nothing and does not show."""
        state = self._at(upto)
        upto, schema = state.last.version, state.struct
        if state.floor is not None and after + 1 < state.floor:
            raise VersionNotFound(f"versions before {state.floor} have been expired")
        picked = [c for c in self._between(after + 1, upto) if c.operation != OPTIMIZE]
        parts = [
            self._scan([c for c in picked if c.kind == kind], schema, versions=True)
            .withColumn("_change", F.lit(kind))
            for kind in (APPEND, UPSERT) if any(c.kind == kind for c in picked)
        ]
        for c in picked:
            if c.kind in (OVERWRITE, RESTORE):
                gone, come = self._replaced(c.version, schema)
                for rows, change in ((gone, DELETE), (come, INSERT)):
                    if rows is not None:
                        parts.append(rows.withColumns({_VERSION: F.lit(c.version).cast("bigint"), "_change": F.lit(change)}))
        if not parts:
            return self._empty(schema).withColumns(
                {_VERSION: F.lit(None).cast("bigint"), "_change": F.lit(None).cast("string")})
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _replaced(self, version: int, schema: T.StructType) -> tuple[DataFrame | None, DataFrame | None]:
        """The rows that a commit took away, and those it brought (None: surely none).

        Where both sides are made of appends, the rows of a commit that both have cancel out whole, so
        neither is read; rows are compared only if each side has commits that the other lacks."""
        def shown(df: DataFrame) -> DataFrame:
            return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

        new = self._at(version)
        if not version:
            return None, shown(self.read(version))
        old = self._at(version - 1)
        had, has = self._appended(old), self._appended(new)
        if had is None or has is None or old.struct != new.struct:
            before, after = shown(self.read(version - 1)), shown(self.read(version))
        else:
            before, after = (
                shown(self._assemble([c for c in self._live(state) if c.operation == OPTIMIZE or c.version in own], state.struct, versions=True)
                      .where(F.col(_VERSION).isin(sorted(own)))) if own else None
                for state, own in ((old, had - has), (new, has - had)))
        if before is None or after is None:
            return before, after
        return before.exceptAll(after), after.exceptAll(before)

    def _appended(self, state: State) -> set[int] | None:
        """The commits whose rows make up a version, seen through compactions and restores; None
        if upserts had a part in it."""
        found = self._between(state.start or 0, state.last.version)
        if any(c.kind == UPSERT for c in found):
            return None
        first, own = found[0], {c.version for c in found if c.kind == APPEND}
        if first.kind == RESTORE:
            under = self._appended(self._state(first.refers_to))
        elif first.kind == OVERWRITE and first.operation == OPTIMIZE:
            under = self._appended(self._state(first.version - 1))
        else:
            return own | {first.version}
        return None if under is None else own | under

    def images(self, after: int, upto: int | None = None) -> DataFrame:
        """Every row that an upsert after one version, up to another, brought: its key, ``before`` (what its
        key held until then, or NULL), ``after`` and ``_version``.

        A window over the versions of a key pairs them, so each key's rows meet once whatever the
        number of commits.  Images reach back to the last full write; NULL keys have none before."""
        state = self._at(upto)
        live = [c for c in self._live(state)]
        keys = next((c.keys for c in reversed(live) if c.kind == UPSERT), state.last.keys)
        rest = [n for n in state.struct.names if n not in keys]
        rows = self._scan(live, state.struct, versions=True)
        row = F.struct(*rest)
        versions = Window.partitionBy(*keys).orderBy(_VERSION)
        named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        paired = rows.select(*keys, F.when(named, F.lag(row).over(versions)).alias("before"), row.alias("after"), _VERSION)
        upserts = [c.version for c in live if c.kind == UPSERT and c.version > after]
        return paired.where(F.col(_VERSION).isin(upserts))

    def _empty(self, schema: T.StructType) -> DataFrame:
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    # -- writing --------------------------------------------------------------

    def _write(
        self, df: DataFrame, kind: str, operation: str, *,
        partition_by: list[str] | None = None, keys: list[str] | None = None,
        replace_schema: bool = False, metrics: dict[str, Column] | None = None,
        facts: dict | None = None, writer: str | None = None, batch: int | None = None,
        replay: bool = False, now: dt.datetime | None = None,
    ) -> int:
        state = self._state(writer=writer)
        last = state.last
        if batch is not None and state.batch is not None and state.batch >= batch and not replay:
            return last.version              # this batch is already in the table
        version = last.version + 1 if last else 0
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema if f.name != _ORIGIN])
        if last and not replace_schema:
            # a column's value for old files is not meant for new rows that lack it
            filled = [f for f in state.struct if EXISTS_DEFAULT in f.metadata and f.name not in df.columns]
            df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in filled})
            schema = _merged_schema(state.struct, schema)
        if kind == UPSERT:
            pending = {tuple(c.keys) for c in self._live(state) if c.kind == UPSERT} - {tuple(keys)}
            if pending:
                raise ValueError(f"upserts on {sorted(pending)} are pending; compact before upserting on {list(keys)}")
        if partition_by is None:
            partition_by = last.partition_by if last else []
        elif last and kind in (APPEND, UPSERT) and list(partition_by) != list(last.partition_by):
            raise ValueError(f"the table is partitioned by {last.partition_by}, not by {list(partition_by)}")
        if keys is None:
            keys = last.keys if last else []
        watch = {"row_count": F.count(F.lit(1)), **(metrics or {})}
        seen = Observation()
        directory = f"_commit={version}-{uuid.uuid4().hex[:12]}"
        out = df.observe(seen, *[c.alias(n) for n, c in watch.items()]).write.option("compression", CODEC)
        if partition_by:
            out = out.partitionBy(*partition_by)
        out.parquet(self._directory(directory))
        found = dict(seen.get)
        row_count = found.pop("row_count")
        return self._publish(Commit(
            version=version, committed_at=now or dt.datetime.now(), operation=operation, kind=kind,
            directory=directory, row_count=row_count,
            metrics=json.dumps({**found, **(facts or {})}, default=str, sort_keys=True),
            schema=None if schema == state.struct else schema.json(),
            partition_by=list(partition_by), keys=list(keys), writer=writer, batch=batch))

    def append(self, df: DataFrame, **options) -> int:
        """Add rows; new columns are welcome.  ``writer`` and ``batch`` make a
        replayed batch a no-op."""
        return self._write(df, APPEND, options.pop("operation", "APPEND"), **options)

    def overwrite(self, df: DataFrame, **options) -> int:
        """Replace all rows and the schema.  Reading the table in ``df`` is fine:
        earlier directories stay in place."""
        options.setdefault("replace_schema", True)
        return self._write(df, OVERWRITE, options.pop("operation", "OVERWRITE"), **options)

    def upsert(self, df: DataFrame, keys: list[str], check_unique: bool = True, **options) -> int:
        """Insert rows, replacing those with the same key.  The first upsert creates
        the table.  A key given twice is an error unless the caller vouches for it."""
        if check_unique:
            keyed = df.dropna(subset=keys)
            if not keyed.groupBy(*keys).count().where("count > 1").isEmpty():
                raise ValueError(f"several source rows share a key in {keys}")
        if not self.exists():
            return self._write(df, OVERWRITE, options.pop("operation", "MERGE"), keys=keys,
                               replace_schema=True, **options)
        return self._write(df, UPSERT, options.pop("operation", "MERGE"), keys=keys, **options)

    def restore(self, version: int, now: dt.datetime | None = None) -> int:
        """Make an old version current again, as a new version.  Only the log grows:
        no row is copied."""
        old, latest = self._at(version), self._state()
        return self._publish(Commit(
            version=latest.last.version + 1, committed_at=now or dt.datetime.now(), operation="RESTORE", kind=RESTORE,
            refers_to=version, schema=None if old.struct == latest.struct else old.struct.json(),
            partition_by=old.last.partition_by, keys=old.last.keys))

    def add_columns(self, defaults: dict[str, object], now: dt.datetime | None = None) -> int:
        """Add constant columns that are not there yet; all rows are kept.

        No row is written: the value goes into the schema, and the scan fills it in for the
        files that lack the column.  Rows that are appended later without the column have
        NULL there.  Values may be truth values, numbers, text, dates and times."""
        state = self._at(None)
        last = state.last
        missing = {n: v for n, v in defaults.items() if n not in state.struct.names}
        texts = {n: literal(v) for n, v in missing.items()}
        types = self.spark.range(0).select(*[F.lit(v).alias(n) for n, v in missing.items()]).schema
        added = [T.StructField(f.name, f.dataType, True, {EXISTS_DEFAULT: texts[f.name]}) for f in types]
        return self._publish(Commit(
            version=last.version + 1, committed_at=now or dt.datetime.now(), operation="ADD COLUMNS", kind=WIDEN,
            row_count=0, schema=T.StructType([*state.struct.fields, *added]).json() if added else None,
            partition_by=last.partition_by, keys=last.keys))

    def compact(
        self, target_bytes: int = TARGET_FILE_BYTES, zorder_by: list[str] | None = None,
        now: dt.datetime | None = None,
    ) -> int:
        """Rewrite the current rows into few large files, optionally clustered."""
        from silverlode.operators.layout import pack, zorder

        state = self._at(None)
        live = self._live(state)
        size = sum(path_bytes(self.spark, self._directory(c.directory)) for c in live)
        files = max(1, -(-size // target_bytes))
        rows = self._assemble(live, state.struct, versions=True).withColumnRenamed(_VERSION, _ORIGIN)
        partition_by = state.last.partition_by
        if zorder_by:
            rows = zorder(rows, zorder_by, files, partition_by)
        else:
            rows = pack(rows, files, partition_by, shuffled=any(c.kind == UPSERT for c in live[1:]))
        return self.overwrite(rows, operation=OPTIMIZE, now=now)

    def expire(self, before: dt.datetime, now: dt.datetime | None = None) -> int:
        """Give up time travel to versions older than the one current at ``before``.
        Directories no kept version needs are deleted, also those of failed attempts.
        Returns the oldest version kept.

        The horizon is published first.  If the job dies after that, what is left on
        disk is merely unused and goes with the next call.
        """
        commits = self._all_commits()
        numbered = [c for c in commits if c.kind != EXPIRE]
        floors = [c.version for c in commits if c.kind == EXPIRE]
        floor = max([c.version for c in numbered if c.committed_at <= before] + floors,
                    default=numbered[0].version)
        self._publish(Commit(version=floor, committed_at=now or dt.datetime.now(),
                             operation="EXPIRE", kind=EXPIRE))
        # the oldest kept version needs its chain; later ones need their own directories on top
        chain = self._chain(self._state(floor))
        restored = [c for v in numbered if v.kind == RESTORE and v.version >= floor for c in self._chain(self._state(v.version))]
        kept = {c.directory for c in [*chain, *restored, *[c for c in numbered if c.version >= floor]]}
        for name in list_names(self.spark, f"{self.path}/data"):
            if name not in kept:
                remove_path(self.spark, self._directory(name))
        return floor


def literal(value: object) -> str:
    """A constant as SQL text."""
    match value:
        case bool():
            return str(value).lower()
        case int():
            return str(value) if abs(value) < 2**31 else f"{value}L"
        case float():
            return f"CAST('{value}' AS DOUBLE)"
        case decimal.Decimal():
            return f"{value:f}BD"
        case str():
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        case dt.datetime():
            return f"TIMESTAMP'{value.astimezone(dt.timezone.utc).isoformat(sep=' ')}'"
        case dt.date():
            return f"DATE'{value.isoformat()}'"
    raise TypeError(f"no constant column of {type(value).__name__}")


def compare(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows on both sides, and how many were added, removed, changed and left as
    they were.  Exact: whole rows are compared.

    Rows are paired within a key, equal ones first, so a key given several times (or
    NULL, which is one key) counts each row once: of what is left of a key after equal
    rows, as many as both sides have are changed, the rest are added or removed.  Both
    sides meet in map-side combined counts, never in a join.
    """
    both, shared = _sides(before, after, keys)
    return _paired(both, keys, shared)


def _sides(before: DataFrame, after: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    shared = [c for c in after.columns if c in before.columns and c not in keys]

    def counted(df: DataFrame, old: int) -> DataFrame:
        return df.select(*keys, *shared, F.lit(old).alias("_old"), F.lit(1 - old).alias("_new"))

    return counted(before, 1).unionByName(counted(after, 0)), shared


def _paired(both: DataFrame, keys: list[str], shared: list[str]) -> DataFrame:
    rows = both.groupBy(*keys, *shared).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    same = F.least("_old", "_new")
    by_key = rows.groupBy(*keys).agg(
        F.sum("_old").alias("_old"), F.sum("_new").alias("_new"), F.sum(same).alias("_same"))
    changed = F.least(F.col("_old") - F.col("_same"), F.col("_new") - F.col("_same"))
    by_key = by_key.withColumn("_changed", changed)

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    old, new, same, changed = (F.col(c) for c in ("_old", "_new", "_same", "_changed"))
    return by_key.agg(
        total(old).alias("rows_before"), total(new).alias("rows_after"),
        total(new - same - changed).alias("added"), total(old - same - changed).alias("removed"),
        total(changed).alias("changed"), total(same).alias("unchanged"))


def _hash(columns: list[str], seed: int) -> Column:
    """A 64-bit hash in which a missing value counts by its place."""
    return F.xxhash64(F.lit(seed), *columns, *[F.col(c).isNull() for c in columns])


def compare_changed(before: DataFrame, after: DataFrame, keys: list[str], buckets: int = 1 << 16) -> DataFrame:
    """What ``compare`` returns, for sides that are mostly equal, with ``buckets_held`` and ``buckets_compared``.

    Rows fall into ``buckets`` by a hash of their key.  One map-side combined aggregate gives each bucket its row counts and
    two digests that do not depend on the order of rows (a sum that takes the old side off the new one, and an
    exclusive or).  Buckets whose sides agree are counted as they are; only rows of the others are
    shuffled and compared as a whole.  Equality of a bucket is that of 128 bits.  Both sides are read twice.
    """
    both, shared = _sides(before, after, keys)
    both = both.withColumn("_bucket", F.pmod(_hash(keys, 0), F.lit(buckets)).cast("int"))
    sign = F.col("_new") - F.col("_old")
    names = [*keys, *shared]
    digest = both.groupBy("_bucket").agg(
        F.sum("_old").alias("_old"), F.sum("_new").alias("_new"),
        F.sum(_hash(names, 1).cast("decimal(20,0)") * sign).alias("_sum"), F.bit_xor(_hash(names, 2)).alias("_xor"))
    digest = digest.withColumn("_equal", (F.col("_old") == F.col("_new")) & (F.col("_sum") == 0) & (F.col("_xor") == 0))
    # at most ``buckets`` numbers, whatever the size of the sides
    other = F.broadcast(digest.where(~F.col("_equal")).select("_bucket"))
    found = _paired(both.join(other, "_bucket", "left_semi"), keys, shared)
    agreed = F.sum(F.when(F.col("_equal"), F.col("_old")))
    whole = digest.agg(
        *[agreed.alias(n) for n in ("rows_before", "rows_after", "unchanged")],
        F.count(F.lit(1)).alias("buckets_held"), F.count_if(~F.col("_equal")).alias("buckets_compared"))
    names = [*found.columns, "buckets_held", "buckets_compared"]
    return found.unionByName(whole, allowMissingColumns=True).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def check_append(table: VersionedTable, before: int, after: int) -> DataFrame:
    """Row counts of two versions against the rows the commits between them report.
    ``consistent`` is true when nothing was lost or doubled."""
    written = table.log().where(
        (F.col("kind") == APPEND) & (F.col("version") > before) & (F.col("version") <= after))
    one = F.count(F.lit(1))
    facts = (
        table.read(before).agg(one.alias("rows_before"))
        .unionByName(written.agg(F.sum("row_count").alias("rows_written")), allowMissingColumns=True)
        .unionByName(table.read(after).agg(one.alias("rows_after")), allowMissingColumns=True)
    )
    names = ["rows_before", "rows_written", "rows_after"]
    return facts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).withColumn(
        "consistent", F.col("rows_before") + F.col("rows_written") == F.col("rows_after"))
