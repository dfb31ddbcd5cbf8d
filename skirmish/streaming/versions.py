"""Tables that change a few buckets per batch, under one commit record.

``VersionLog`` keeps numbered JSON records in a folder; a record appears by a rename, so a reader sees all of it or none.

``BucketStore`` holds several tables below one root.  A *keyed* table is cut into hash buckets of its key: a batch rewrites only
the buckets its keys fall into, merging new rows into old ones column by column (minimum, sum, any, ...), and every
other bucket keeps its files.  An *appended* table gets one folder per batch.  The record of a version names the live
folders of all tables, so whatever a batch writes (several tables, or rows and a cursor) becomes visible at once:

    <root>/_log/v=<version>.json
    <root>/<table>/v=<version>-<attempt>/__b=<bucket>/...   keyed
    <root>/<table>/v=<version>-<attempt>/...                appended

Readers take the newest record, never a listing of data folders.  A batch starts from the newest version before its own, so
a replay gives the same rows; files a reader may hold are never overwritten.  ``fold`` rewrites the many small folders
of an appended table as one and commits that as a version of its own; a batch that was planned before the fold and commits after it
only brings the small folders back.  ``expire`` removes what no kept version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

PARTS = 1000   # versions a batch may have (batch, folds after it)
BUCKETS = 64
FOLD_AT = 32   # folders of an appended table that make a fold worth it


class VersionLog:
    """Numbered commit records below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        """Committed versions, oldest first (one listing)."""
        fs, path = self._fs()
        if not fs.exists(path(self.path)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path(self.path))]
        return sorted(int(n[2:-5]) for n in names if n.startswith("v=") and n.endswith(".json"))

    def load(self, version: int) -> dict:
        fs, path = self._fs()
        stream = fs.open(path(f"{self.path}/v={version:020d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self, before: int | None = None) -> tuple[int, dict] | None:
        """(version, record) of the newest version, or the newest below ``before``."""
        known = [v for v in self.versions() if before is None or v < before]
        return (known[-1], self.load(known[-1])) if known else None

    def commit(self, version: int, record: dict) -> None:
        """Publish a record; a replay replaces its own earlier one."""
        fs, path = self._fs()
        final, attempt = f"{self.path}/v={version:020d}.json", f"{self.path}/_{uuid.uuid4().hex}"
        out = fs.create(path(attempt))
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(path(attempt), path(final), options)

    def remove(self, version: int) -> None:
        fs, path = self._fs()
        fs.delete(path(f"{self.path}/v={version:020d}.json"), False)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class Keyed:
    """A table with one row per key; ``merge`` has the aggregate that joins old and new values of each other column."""

    schema: str
    key: tuple[str, ...]
    merge: dict[str, Callable[[str], Column]]


@dataclass(frozen=True)
class Appended:
    schema: str


class BucketStore:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Keyed | Appended], buckets: int = BUCKETS):
        self.spark, self.root, self.tables, self.buckets = spark, root.rstrip("/"), tables, buckets
        self.log = VersionLog(spark, f"{self.root}/_log")

    # ---- writes ---------------------------------------------------------------
    def _grouped(self, rows: DataFrame, table: Keyed) -> DataFrame:
        types = T._parse_datatype_string(table.schema)
        if not table.merge:  # all columns are key
            return rows.select("__b", *types.fieldNames()).distinct()
        return rows.groupBy("__b", *table.key).agg(
            *[fn(c).cast(types[c].dataType).alias(c) for c, fn in table.merge.items()]).select("__b", *types.fieldNames())

    def merge(self, changes: dict[str, DataFrame], batch_id: int) -> None:
        """Merge rows into keyed tables and append rows to the others, all in one commit."""
        version = (batch_id + 1) * PARTS
        found = self.log.newest(version)
        live = found[1]["tables"] if found else {}
        for name, rows in changes.items():
            table, folder = self.tables[name], f"{name}/v={version:020d}-{uuid.uuid4().hex[:8]}"
            fields = T._parse_datatype_string(table.schema).fieldNames()
            if isinstance(table, Appended):
                if not rows.isEmpty():
                    rows.select(*fields).write.parquet(f"{self.root}/{folder}")
                    live = {**live, name: {**live.get(name, {}), folder: folder}}
                continue
            bucket = F.pmod(F.xxhash64(*table.key), F.lit(self.buckets)).cast("int").alias("__b")
            changed = scratch_path(self.spark, f"changes-{name}")
            self._grouped(rows.select(bucket, *fields), table).write.parquet(changed)  # partial sums first
            rows = self.spark.read.parquet(changed)
            touched = [str(r[0]) for r in rows.select("__b").distinct().collect()]  # at most ``buckets`` numbers
            if not touched:
                _delete(self.spark, changed)
                continue
            old = live.get(name, {})
            kept = [old[b] for b in touched if b in old]
            if kept:
                rows = rows.unionByName(self._read(name, kept).select(bucket, *fields))
            self._grouped(rows.repartition("__b"), table).write.partitionBy("__b").parquet(f"{self.root}/{folder}")
            live = {**live, name: {**old, **{b: f"{folder}/__b={b}" for b in touched}}}
            _delete(self.spark, changed)
        self.log.commit(version, {"tables": live})

    def next_batch(self) -> int:
        """Number of the batch after the newest committed one."""
        found = self.log.versions()
        return found[-1] // PARTS if found else 0

    def fold(self, name: str, at_least: int = FOLD_AT, files: int = 1) -> bool:
        """Rewrite the folders of an appended table as one of ``files`` files, if there are ``at_least`` of them."""
        found = self.log.newest()
        folders = found[1]["tables"].get(name, {}) if found else {}
        if len(folders) < at_least:
            return False
        version = found[0] + 1
        folder = f"{name}/v={version:020d}-{uuid.uuid4().hex[:8]}"
        self._read(name, list(folders.values())).repartition(files).write.parquet(f"{self.root}/{folder}")
        self.log.commit(version, {"tables": {**found[1]["tables"], name: {folder: folder}}})
        return True

    def expire(self, keep: int = 288) -> None:
        """Remove all but the newest ``keep`` versions and the folders that none of them names."""
        versions = self.log.versions()
        kept = versions[-keep:]
        if not kept:
            return
        named = {f.split("/__b=")[0] for v in kept for t in self.log.load(v)["tables"].values() for f in t.values()}
        for v in versions[:-keep]:
            self.log.remove(v)
        fs, path = self.log._fs()
        for name in self.tables:
            if not fs.exists(path(f"{self.root}/{name}")):
                continue
            for status in fs.listStatus(path(f"{self.root}/{name}")):
                folder = status.getPath().getName()
                # a folder of a version not yet committed is somebody's work in progress
                if f"{name}/{folder}" not in named and int(folder[2:22]) < kept[-1]:
                    fs.delete(status.getPath(), True)

    # ---- reads ----------------------------------------------------------------
    def folders(self, name: str, version: int | None = None) -> dict[str, str]:
        """Live folders of a table by bucket (or by themselves), as of the newest version or of a given one."""
        found = self.log.newest() if version is None else (version, self.log.load(version))
        return found[1]["tables"].get(name, {}) if found else {}

    def _read(self, name: str, folders: list[str]) -> DataFrame:
        schema = T._parse_datatype_string(self.tables[name].schema)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self._read(name, list(self.folders(name, version).values()))
