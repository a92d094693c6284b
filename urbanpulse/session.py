"""Session construction and shared scratch locations.

Scratch data (landed CSV/JSON pages, round-trip sinks) always goes under the
cluster's shared checkpoint folder (``spark.checkpoint.dir``), read from the
running session.  A folder of our own is created only when the session has
none, which happens in ad-hoc local runs and tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings we rely on; every one is a public Spark SQL option.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # remove reliable-checkpoint files once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Settings for a large cluster (hundreds of TB, ~1000 executors).  Shuffles
# start wide and AQE coalesces them to ~256 MB partitions; scans read 256 MB
# splits; a partition over 5x the median and 512 MB is split by the skew-join
# rule; runtime broadcasts up to 64 MB.  Queries never depend on these: they
# are plan-level choices, and the library works under any session.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def get_session(master: str | None = None, app: str = "urbanpulse",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, profile: str = "local") -> SparkSession:
    """``profile="cluster"`` adds CLUSTER_CONF; the checkpoint folder is
    whatever the cluster names in ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting a local session (one machine) gets a temporary folder
    of its own; any other session is an error, as its executors would write to
    their own disks."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="urbanpulse-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir().rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/urbanpulse-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below this application's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# Names of the tables over scratch data, by application.
_SCRATCH_TABLES: dict[str, set[str]] = {}


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh table name that ``clear_scratch`` of this application drops."""
    own = f"{name}_{uuid.uuid4().hex[:10]}"
    _SCRATCH_TABLES.setdefault(spark.sparkContext.applicationId, set()).add(own)
    return own


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application has staged, and the tables that it
    named by ``scratch_table``; no other table.  Frames that read staged data
    can't be used afterwards."""
    for name in _SCRATCH_TABLES.pop(spark.sparkContext.applicationId, ()):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    fs, p = hadoop_fs(spark, scratch_root(spark))
    fs.delete(p, True)


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path objects for ``path`` (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_subfolders(spark: SparkSession, path: str) -> list[str]:
    """Child directories of ``path`` (metadata listing, no data read)."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        if st.isDirectory():
            name = st.getPath().getName()
            if not name.startswith(("_", ".")):
                out.append(st.getPath().toString())
    return sorted(out)


def materialize(df):
    """Reliable checkpoint into the shared checkpoint folder: computes ``df``
    once, cuts its lineage (later stages re-read the files, so a lost executor
    does not recompute the upstream shuffles).  Used for small aggregated
    tables that several statistics branches read."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df, name: str, path: str | None = None, partition_by: str | None = None, **options):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    return it re-read: the lineage is cut like ``materialize``, but the stored
    form is columnar and splittable, so each later branch reads only the
    columns it needs.  For large intermediates (e.g. the silver corpus).
    ``path`` is for a caller that will drop the table again (``drop_path``),
    ``options`` are the writer's own."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    w = df.write.mode("overwrite").options(**options)
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files at or below ``path`` (metadata listing)."""
    fs, p = hadoop_fs(spark, path)
    return fs.getContentSummary(p).getLength()


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of ours.  Frames that read it can't be used afterwards."""
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing refers to: it does
    so once the driver has collected their objects, by itself at long intervals only."""
    spark.sparkContext._jvm.System.gc()
