"""Session and shared-storage helpers.

Jobs never pick a machine-local folder on a cluster: anything written mid-job
(checkpoints, staged tables, streaming state) goes below the folder the cluster
names in ``spark.checkpoint.dir``. Only when that setting is absent (local runs
and tests) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "dcflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here assumes (UTC, AQE, no UI)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # checkpoints written per batch are removed once nothing refers to them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir); if
    neither is set, create a private folder and register it in local mode, and
    refuse to run on a cluster (a machine-local folder would not survive the
    loss of an executor).
    """
    sc = spark.sparkContext
    d = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        # spark.checkpoint.dir cannot be changed at runtime; the context's
        # checkpoint dir can, and it is what checkpoint() uses
        d = tempfile.mkdtemp(prefix="dcflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in this application's folder below the shared checkpoint
    folder. The application's folder is deleted when its driver ends."""
    base = checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    own = f"{base}{sep}dcflow/{spark.sparkContext.applicationId}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back, so its plan runs once."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which Spark broadcasts a join's side by itself (below 0: never)."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def make_dirs(spark: SparkSession, path: str) -> None:
    """Create a folder (and parents) through Hadoop's FileSystem."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder (empty if it does not exist)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through Hadoop's FileSystem."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works for any scheme."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(hconf)
    return bool(fs.exists(p))


__all__ = ["build_session", "checkpoint_dir", "scratch_path", "written", "shuffle_partitions",
           "path_exists", "remove_path", "make_dirs", "list_names", "broadcast_limit", "folder_bytes"]
