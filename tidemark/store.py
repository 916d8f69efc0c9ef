"""Versioned Parquet tables: atomic publication, ledger, time travel, maintenance.

A table is a folder of immutable data directories and a log of manifests, one
JSON file a version. A manifest lists, for each bucket of the key's hash, the
directories that make up its current rows, and holds schema, ledger and audit
counters of that commit, so data and ledger appear together or not at all. All
access goes through Spark's file system layer: local folders, HDFS and object
stores alike.

Two writers that start from one version claim the same next manifest; the second
finds it taken and fails with ``Conflict``. (On a store without atomic
create-if-absent, run one writer a table.)
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.apply import apply_changes, conform, payload_columns

BUCKET = "__bucket"


class Conflict(RuntimeError):
    """Another commit came first."""


@dataclass(frozen=True)
class Manifest:
    version: int
    committed_at: float
    operation: str
    schema: dict
    keys: list[str]
    buckets: int
    #: Bucket (as text) to data directories, relative to the table.
    files: dict[str, list[str]]
    #: Applied batches: id to counters.
    ledger: dict[str, dict] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)


class Store:
    """writers: tasks that write a bucket's rows; more where a bucket is large for one."""

    def __init__(self, spark: SparkSession, root: str, writers: int = 1) -> None:
        self.spark, self.root, self.writers = spark, root.rstrip("/"), writers
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # Files

    def _at(self, *parts: str):
        return self._path("/".join([self.root, *parts]))

    def _list(self, *parts: str) -> list:
        at = self._at(*parts)
        return list(self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _read_text(self, at) -> str:
        stream = self._fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _publish(self, table: str, manifest: Manifest) -> None:
        """Write aside, then rename to the version's name if that is free."""
        own = self._at(table, "_log", f".{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(own, False)
        stream.write(bytearray(json.dumps(asdict(manifest)).encode()))
        stream.close()
        name = self._at(table, "_log", f"{manifest.version:012d}.json")
        if self._fs.exists(name) or not self._fs.rename(own, name):
            self._fs.delete(own, False)
            raise Conflict(f"version {manifest.version} of {table} is taken")

    # Versions

    def versions(self, table: str) -> list[int]:
        names = [s.getPath().getName() for s in self._list(table, "_log")]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, table: str, version: int | None = None, as_of: float | None = None) -> Manifest | None:
        """The newest manifest, that of a version, or the newest committed by a time."""
        known = self.versions(table)
        if version is not None:
            known = [v for v in known if v == version]
        for v in reversed(known):
            m = Manifest(**json.loads(self._read_text(self._at(table, "_log", f"{v:012d}.json"))))
            if as_of is None or m.committed_at <= as_of:
                return m
        if version is not None or (as_of is not None and known):
            raise ValueError(f"{table} has no version {version if version is not None else f'as of {as_of}'}")
        return None

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def read(self, table: str, version: int | None = None, as_of: float | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """Current rows, or those of an earlier version or time; only some buckets if asked."""
        m = self.manifest(table, version, as_of)
        if m is None:
            raise ValueError(f"no table {table}")
        wanted = None if buckets is None else {str(b) for b in buckets}
        dirs = sorted({d for b, ds in m.files.items() if wanted is None or b in wanted for d in ds})
        if not dirs:
            return self.spark.createDataFrame([], m.struct)
        # Older files lack columns that came later: the declared schema reads them as null.
        return self.spark.read.schema(m.struct).parquet(*[f"{self.root}/{table}/{d}" for d in dirs])

    def snapshots(self, table: str) -> DataFrame:
        """(snapshot_id, committed_at, operation), one row a version."""
        rows = [(m.version, m.committed_at, m.operation) for m in (self.manifest(table, v) for v in self.versions(table))]
        df = self.spark.createDataFrame(rows, "snapshot_id bigint, at double, operation string")
        return df.select("snapshot_id", F.timestamp_seconds("at").alias("committed_at"), "operation")

    def applied(self, table: str, batch_id: str) -> bool:
        m = self.manifest(table)
        return m is not None and batch_id in m.ledger

    # Writing

    def _bucket_of(self, keys: Sequence[str], buckets: int):
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int") if keys else F.lit(0)

    def _write(self, table: str, df: DataFrame, keys: Sequence[str], buckets: int) -> dict[str, list[str]]:
        """Write rows into a new data directory by bucket; what lies where."""
        name = f"data/{uuid.uuid4().hex}"
        target = f"{self.root}/{table}/{name}"
        dealt = df.withColumn(BUCKET, self._bucket_of(keys, buckets))
        if buckets > 1 or self.writers > 1:
            # Each bucket's rows go to so many tasks, by another hash of the keys.
            part = F.pmod(F.xxhash64(F.lit(buckets), *[F.col(k).cast("string") for k in keys]), F.lit(self.writers))
            dealt = dealt.repartition(buckets * self.writers, F.col(BUCKET), part)
        dealt.write.partitionBy(BUCKET).parquet(target)
        found = [s.getPath().getName() for s in self._list(table, *name.split("/")) if s.isDirectory()]
        return {n.partition("=")[2]: [f"{name}/{n}"] for n in found if n.startswith(f"{BUCKET}=")}

    def _commit(self, table: str, base: Manifest | None, operation: str, schema: T.StructType, keys: Sequence[str], buckets: int, files: dict, ledger: dict) -> Manifest:
        m = Manifest((base.version if base else 0) + 1, time.time(), operation, json.loads(schema.json()), list(keys), buckets, files, ledger)
        self._publish(table, m)
        return m

    def ensure(self, table: str, schema: T.StructType, keys: Sequence[str] = (), buckets: int = 1) -> Manifest:
        """The table, made empty if it isn't there."""
        return self.manifest(table) or self._commit(table, None, "create", schema, keys, buckets, {}, {})

    def replace(self, table: str, df: DataFrame, keys: Sequence[str] = (), buckets: int = 1) -> Manifest:
        """All rows anew, in one commit (create or replace as select)."""
        base = self.manifest(table)
        files = self._write(table, df, keys, buckets)
        return self._commit(table, base, "replace", df.schema, keys, buckets, files, base.ledger if base else {})

    def add_columns(self, table: str, added: Sequence[tuple[str, str]]) -> Manifest:
        """Columns at the end; stored rows have null there. No data is rewritten."""
        base = self.manifest(table)
        schema = T.StructType([*base.struct.fields, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in added]])
        return self._commit(table, base, "add columns", schema, base.keys, base.buckets, base.files, base.ledger)

    def widen_columns(self, table: str, changes: Sequence[tuple[str, str, str]]) -> Manifest:
        """New types for columns; rows are cast and rewritten, for files keep their types."""
        base = self.manifest(table)
        kinds = {n: T._parse_datatype_string(new) for n, _, new in changes}
        schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in base.struct.fields])
        files = self._write(table, conform(self.read(table), schema), base.keys, base.buckets)
        return self._commit(table, base, "widen columns", schema, base.keys, base.buckets, files, base.ledger)

    def apply(self, table: str, changes: DataFrame, batch_id: str, counters: dict | None = None, insert_on_match: str = "ignore") -> Manifest:
        """Apply changes (one row a key) and record the batch, in one commit.

        Only buckets that the changes touch are read and written; a batch that
        the ledger has is left alone.
        """
        base = self.manifest(table)
        if batch_id in base.ledger:
            return base
        bucket = self._bucket_of(base.keys, base.buckets)
        # At most as many rows as there are buckets.
        touched = sorted(r.b for r in changes.select(bucket.alias("b")).distinct().collect())
        ledger = {**base.ledger, batch_id: counters or {}}
        if not touched:
            return self._commit(table, base, "apply", base.struct, base.keys, base.buckets, base.files, ledger)
        current = self.read(table, base.version, buckets=touched)
        state = conform(apply_changes(current, changes, base.keys, insert_on_match), base.struct)
        files = {b: ds for b, ds in base.files.items() if int(b) not in touched} | self._write(table, state, base.keys, base.buckets)
        return self._commit(table, base, "apply", base.struct, base.keys, base.buckets, files, ledger)

    def evolve(self, table: str, changes: DataFrame) -> None:
        """Add the columns that changes bring and the table lacks."""
        base = self.manifest(table)
        known = set(base.struct.names)
        new = [(c, changes.schema[c].dataType.simpleString()) for c in payload_columns(changes) if c not in known]
        if new:
            self.add_columns(table, new)

    # Maintenance

    def _data_files(self, table: str) -> list[tuple[str, int, float]]:
        """(directory, bytes, modified) of every data file."""
        out, todo = [], [self._at(table, "data")]
        while todo:
            at = todo.pop()
            for s in list(self._fs.listStatus(at)) if self._fs.exists(at) else []:
                if s.isDirectory():
                    todo.append(s.getPath())
                else:
                    folder = s.getPath().getParent().toString()
                    out.append((folder[folder.index(f"/{table}/data/") + len(table) + 2 :], s.getLen(), s.getModificationTime() / 1000))
        return out

    def live_files(self, table: str) -> int:
        """How many non-empty data files the newest version has."""
        dirs = {d for ds in self.manifest(table).files.values() for d in ds}
        return sum(n > 0 for folder, n, _ in self._data_files(table) if folder in dirs)

    def compact(self, table: str, target_bytes: int = 128 << 20, min_files: int = 5) -> Manifest | None:
        """Rewrite buckets of at least ``min_files`` files into files of about the target size."""
        base = self.manifest(table)
        sizes: dict[str, list[int]] = {}
        for folder, size, _ in self._data_files(table):
            sizes.setdefault(folder, []).append(size)
        files, changed = dict(base.files), False
        for b, dirs in base.files.items():
            own = [n for d in dirs for n in sizes.get(d, []) if n > 0]
            parts = max(1, math.ceil(sum(own) / target_bytes))
            if len(own) < min_files or len(own) <= parts:
                continue
            name = f"data/{uuid.uuid4().hex}/{BUCKET}={b}"
            self.read(table, base.version, buckets=[int(b)]).repartition(parts).write.parquet(f"{self.root}/{table}/{name}")
            files[b], changed = [name], True
        return self._commit(table, base, "compact", base.struct, base.keys, base.buckets, files, base.ledger) if changed else None

    def expire(self, table: str, older_than: float, keep: int = 5) -> list[int]:
        """Drop manifests from before a time, but never the newest ``keep``."""
        gone = []
        for v in self.versions(table)[:-keep] if keep else self.versions(table):
            if self.manifest(table, v).committed_at < older_than:
                self._fs.delete(self._at(table, "_log", f"{v:012d}.json"), False)
                gone.append(v)
        return gone

    def remove_orphans(self, table: str, older_than: float) -> list[str]:
        """Delete data directories that no manifest names and that are old enough not to be in the making."""
        named = {d for v in self.versions(table) for ds in self.manifest(table, v).files.values() for d in ds}
        named |= {d.rpartition("/")[0] for d in named}  # a write's own folder, which holds its markers
        newest: dict[str, float] = {}
        for folder, _, at in self._data_files(table):
            newest[folder] = max(newest.get(folder, 0.0), at)
        gone = {d for d, at in newest.items() if d not in named and at < older_than}
        gone = sorted(d for d in gone if d.rpartition("/")[0] not in gone)
        for d in gone:
            self._fs.delete(self._at(table, d), True)
        return gone
