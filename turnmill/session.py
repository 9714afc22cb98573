"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at cluster scale; applied only where the session
# does not set them already (a cluster config always wins).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimension tables here are tiny; anything bigger goes sort-merge.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    # Rows here are CPU-heavy per byte (regex, JSON, rendering): let AQE keep
    # small shuffles spread over all cores (large ones are still sized by
    # the 64 MB advisory partition size).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Window buffers of one conversation spill instead of growing the heap.
    "spark.sql.windowExec.buffer.spill.threshold": "65536",
}


def build_session(master: str = "local[8]", partitions: int = 8, app: str = "turnmill") -> SparkSession:
    """Local session for tests and the bench; never starts the web UI."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder: the cluster's ``spark.checkpoint.dir``. A
    fresh scratch folder is made only for a local master; elsewhere a
    missing setting is an error, as executors would not share it."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="turnmill-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of executors, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once to the shared checkpoint folder as Parquet:
    its readers fetch only the columns that they use."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def store_bucketed(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Like ``store``, in as many buckets of ``by`` as the session has shuffle
    partitions: a join on these columns needs no exchange of the table."""
    spark = df.sparkSession
    n, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}"
    path = os.path.join(ensure_checkpoint_dir(spark), table)
    df.write.bucketBy(n, *by).option("path", path).saveAsTable(table)
    return spark.table(table)


def _files(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str, committed: bool = True) -> list[int]:
    """Numbers of the versions under ``root``, ascending. A version counts as
    committed once its write has left the ``_SUCCESS`` marker, its last act."""
    fs, path = _files(spark, root)
    found = []
    for s in fs.listStatus(path) if fs.exists(path) else []:
        name = s.getPath().getName()
        if name.startswith("v") and name[1:].isdigit() and (
                not committed or fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))):
            found.append(int(name[1:]))
    return sorted(found)


def write_version(df: DataFrame, root: str) -> str:
    """Write ``df`` as the next version under ``root``; earlier ones stay as
    they are, so a stopped write takes nothing away. Returns ``root``."""
    n = max(versions(df.sparkSession, root, committed=False), default=0) + 1
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{root}/v{n:06d}")
    return root


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """The last committed version under ``root``."""
    found = versions(spark, root)
    if not found:
        raise ValueError(f"no committed version under {root}")
    return spark.read.parquet(f"{root}/v{found[-1]:06d}")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
