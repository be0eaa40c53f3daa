"""Session helpers: where scratch output goes, and a local session for tests.

Everything this package writes between steps (landed pages, CSV stages, table
versions) goes under the folder the cluster names in ``spark.checkpoint.dir``.
On a cluster that folder is shared storage (HDFS, object store), so a lost
executor never takes staged files with it. Only a local master may fall back
to a fresh temporary folder when the setting is missing.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _checkpoint_root(spark: SparkSession) -> str | None:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return root or None


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch root, read from the session.

    If unset and the master is local (tests), a temporary folder is made and
    registered as the checkpoint dir; on a cluster a missing setting is an
    error rather than a silent machine-local path.
    """
    root = _checkpoint_root(spark)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise ValueError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "before staging data on a cluster"
        )
    root = tempfile.mkdtemp(prefix="tableload-")
    spark.sparkContext.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder path under the scratch root."""
    return f"{scratch_root(spark)}/tableload/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written under the scratch root and read back (its lineage ends there), and the folder."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of the file system it lies in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more, through the file system it lies in."""
    if not path.startswith(f"{scratch_root(spark)}/tableload/"):
        raise ValueError(f"not a scratch folder: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def local_session(cores: int = 8, shuffle_partitions: int = 8, extra: dict[str, str] | None = None) -> SparkSession:
    """Session used by tests and the bench (local mode, UI off, UTC); ``extra`` adds settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tableload")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
