"""Session construction and the shared scratch folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` (or the context's
checkpoint directory) names. A local folder is only created for a local master; any other
session without the setting is refused, since executors could not see such a folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job relies on; a cluster-provided session keeps its own values.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # A window / aggregate gets its own exchange on *all* its keys instead of reusing a
    # join's partitioning on a subset (e.g. the tag): keep-latest then always trims each map
    # task to one row per key before the shuffle, so a hot tag cannot land in one task.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
}


def build_session(master: str = "local[*]", app: str = "herdflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local/test session with the settings the operators assume."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings operators rely on; a setting that the session was
    created with stays as it is."""
    given = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if not given.contains(k):
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared scratch folder (checkpoint directory).

    Read from the session. Where nothing is configured, a local master (tests, local
    runs) gets a temporary folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[[^\]]*\])?$", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="herdflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch root."""
    root = shared_dir(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}herdflow/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared scratch folder and read back, so that several readers do not repeat the work above it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for os-level checks on local paths."""
    return path[5:] if path.startswith("file:") else path


def hadoop_fs(spark: SparkSession, path: str):
    """The JVM and the Hadoop file system of a path."""
    jvm = spark.sparkContext._jvm
    return jvm, jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system of the path (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursive delete through the Hadoop file system (used for committed staging folders)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)

