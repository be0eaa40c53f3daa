"""Bucketed tables: the target is stored hash-bucketed by its key.

When the day is too big to broadcast, the merge joins are sort-merge joins.
Against a target bucketed by the key, Spark reads each bucket as one
partition already hash-partitioned on the key, so only the day is shuffled
(into the same bucket count); the target, the big side, never crosses the
network. Each new state is written with ``bucketBy`` to a fresh version folder
(through a short-lived catalog entry, as ``bucketBy`` writes only via
``saveAsTable``), and the table is then pointed at it, as in ``publish``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.casts import q
from .partitions import _ddl
from .tables import as_nullable, same_shape, version_path


def table_buckets(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """(bucket count, bucket columns) of a catalog table, or None if not bucketed."""
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": name}).collect()
    info = {r["col_name"]: r["data_type"] for r in rows}
    if "Num Buckets" not in info:
        return None
    cols = [c.strip().strip("`") for c in info.get("Bucket Columns", "").strip("[]").split(",") if c.strip()]
    return int(info["Num Buckets"]), cols


def publish_bucketed(spark: SparkSession, df: DataFrame, name: str, root: str, key: str, buckets: int,
                     cluster: bool = True, mark: str = "") -> str:
    """Write ``df`` bucketed by ``key`` as a new version and point table ``name`` at it.

    ``cluster``: hash-partition the rows by ``key`` into ``buckets``
    partitions first (the same hash as the bucket id) with the ``rebalance``
    hint, so a task writes the files of whole buckets rather than a file for
    every bucket it happens to hold (tasks x buckets small files), and AQE
    splits a bucket that holds a hot key over several tasks (a bucket may
    have several files) instead of one task writing a third of the table.
    A merge result is already partitioned by bucket (the target side keeps
    its scan's bucketing), so the merge passes ``cluster=False`` and its
    target is never shuffled.
    """
    path = version_path(root, mark)
    staging = f"{name}__w{uuid.uuid4().hex[:8]}"
    if cluster:
        df = df.hint("rebalance", int(buckets), key)
    (
        df.write.format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .mode("errorifexists")
        .saveAsTable(staging)
    )
    spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": staging})  # external entry: the files stay
    schema = as_nullable(df.schema)
    if spark.catalog.tableExists(name):
        if same_shape(spark.table(name).schema, schema) and table_buckets(spark, name) == (buckets, [key]):
            spark.sql("ALTER TABLE IDENTIFIER(:t) SET LOCATION :loc", args={"t": name, "loc": path})
            spark.catalog.refreshTable(name)
            return path
        spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": name})
    spark.sql(
        f"CREATE TABLE IDENTIFIER(:t) ({_ddl(schema)}) USING parquet "
        f"CLUSTERED BY ({q(key)}) SORTED BY ({q(key)}) INTO {int(buckets)} BUCKETS LOCATION :loc",
        args={"t": name, "loc": path},
    )
    return path
