"""Keyed upsert tables without a key-value store.

The reference upserts into database tables keyed by champion / window slot.
Here a keyed table is a folder of versioned Parquet snapshots, one per
(micro-batch, part):

    <path>/v=00000000000000001000   snapshot after batch 0, part 0
    <path>/v=00000000000000002000   snapshot after batch 1, part 0

An upsert reads the newest complete version before its own, merges the new
rows in (one aggregation by key: the latest non-null value per column, which
is also what makes *partial-column* upserts work) and writes its own folder.
A reader takes the newest version that carries Spark's success marker, so it
never sees a half-written table, and no version that somebody may be reading
is overwritten except by a replay of the very batch that wrote it, which
writes the same rows again.  Versions older than the newest ``keep`` are
removed after a successful write.

The tables are small (a row per champion or per window slot), so a snapshot
per micro-batch costs little; there is no log to fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS = 1000  # parts a batch may have
KEEP = 288    # versions kept: a day of 5-minute batches


class UpsertStore:
    def __init__(self, spark: SparkSession, path: str, key: list[str], schema: str | T.StructType,
                 keep: int = KEEP):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = list(key)
        self.schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        self.values = [f.name for f in self.schema.fields if f.name not in self.key]
        self.keep = keep

    # ---- versions -----------------------------------------------------------
    def _fs(self):
        """(Hadoop file system of the table, function from text to Hadoop path)."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _folder(self, version: int) -> str:
        return f"{self.path}/v={version:020d}"

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        fs, path = self._fs()
        marks = fs.globStatus(path(f"{self.path}/v=*/_SUCCESS")) or []
        return sorted(int(s.getPath().getParent().getName()[2:]) for s in marks)

    def _write(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(self._folder(version))

    # ---- table management -------------------------------------------------
    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def exists(self) -> bool:
        return bool(self.versions())

    def create(self) -> "UpsertStore":
        """Create the table if it does not exist yet."""
        if not self.exists():
            self._write(self._empty(), 0)
        return self

    def truncate(self) -> "UpsertStore":
        """Empty the table (start-of-job reset): all versions go, so a fresh
        checkpoint that counts batches from 0 again starts from nothing."""
        fs, path = self._fs()
        fs.delete(path(self.path), True)
        self._write(self._empty(), 0)
        return self

    # ---- writes -------------------------------------------------------------
    def upsert(self, df: DataFrame, batch_id: int, part: int = 0) -> None:
        """Upsert rows of ``df`` (key + any subset of value columns)."""
        version = (batch_id + 1) * PARTS + part
        cols = [F.col(c) if c in df.columns else F.lit(None).cast(self.schema[c].dataType).alias(c)
                for c in self.key + self.values]
        both = (self._as_of(version).withColumn("__new", F.lit(0))
                .unionByName(df.select(*cols).withColumn("__new", F.lit(1))))
        aggs = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__new"))).alias(c) for c in self.values]
        self._write(both.groupBy(*self.key).agg(*aggs).select(*self.schema.fieldNames()), version)
        self._expire()

    def _expire(self) -> None:
        fs, path = self._fs()
        for old in self.versions()[:-self.keep]:
            fs.delete(path(self._folder(old)), True)

    # ---- reads ---------------------------------------------------------------
    def _as_of(self, version: int | None) -> DataFrame:
        known = [v for v in self.versions() if version is None or v < version]
        if not known:
            return self._empty()
        return self.spark.read.schema(self.schema).parquet(self._folder(known[-1]))

    def read(self, before_batch: int | None = None) -> DataFrame:
        """The newest complete version; ``before_batch`` reads the state as of that batch's start."""
        version = None if before_batch is None else (before_batch + 1) * PARTS
        return self._as_of(version).select(*self.key, *self.values)
