"""Session construction and the shared scratch folder.

Everything that must survive executor loss (stream checkpoints, upsert
stores, exported graph tables, lineage cuts) is written below the folder the
cluster names in ``spark.checkpoint.dir``, or its warehouse when that setting
is absent.  Only in local mode (tests, laptops) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a job of this library wants; cluster-specific sizing (executor
# memory, shuffle partitions) stays with the deployment.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int, target_partition_mb: int = 256) -> dict:
    """Sizing for a large cluster (e.g. 1000 executors over ~100 TB).

    Shuffle partitions start at a few per core and AQE coalesces them toward
    ``target_partition_mb``; skewed partitions (5x the median and above the
    threshold) of a join are split.  Scan splits follow the same target so a
    task reads what it can hold.  The broadcast threshold stays modest: only
    dimensions under it (checked by Spark from statistics, and again at run
    time by AQE) are broadcast; everything else uses a shuffled join.
    """
    mb = f"{target_partition_mb}m"
    return {
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": mb,
        "spark.sql.files.maxPartitionBytes": mb,
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def build_session(master: str | None = None, app_name: str = "skirmish",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared (cluster-visible) scratch space, as a full URI.

    Reads ``spark.checkpoint.dir`` from the session (or the context's
    checkpoint dir).  A path without a scheme lies in Hadoop's default file
    system, as for Spark itself.  If neither is set, a cluster uses its
    warehouse, the other folder that driver and executors share; in local mode,
    as in tests, a folder is created and registered.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        one_machine = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
        root = tempfile.mkdtemp(prefix="skirmish-ckpt-") if one_machine else spark.conf.get("spark.sql.warehouse.dir")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def trigger_bytes(spark: SparkSession, per_core: int = 256 << 20) -> int:
    """Input of a micro-batch: so many bytes for every core, so that batches grow with the cluster."""
    return per_core * max(1, spark.sparkContext.defaultParallelism)


#: Input of a micro-batch of gzipped JSON for every core; such files hold about ten times their size in text.
GZIP_PER_CORE = 32 << 20

CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def clean_shuffles(spark: SparkSession):
    """Whatever runs inside, and the streams started inside, delete their shuffle files as soon as each of their executions ends.

    Otherwise the files stay until the driver happens to collect its garbage, so the disk holds the shuffles of many micro-batches.
    """
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for one job's outputs, directly below the shared root.

    No folder in between is common to all jobs: it would belong to the user
    whose job came first, and nobody else could write below it.
    """
    root = shared_dir(spark)
    return f"{root}/skirmish-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` once to the shared folder and return a lazy read of it.

    Used where several branches of one plan consume the same expensive
    intermediate (the normalised edges of the graph job): they then scan a
    column-pruned Parquet table instead of recomputing it, and the lineage is
    cut, so a lost executor never replays the upstream joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
