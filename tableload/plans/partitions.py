"""Partitioned tables: copy-on-write at partition granularity.

A table partitioned by a value derived from a stable record column (creation
month, say) lets a daily merge touch only the partitions that hold the day's
keys, instead of rewriting the whole table:

1. ``touched`` = partitions holding a day key in the target (a key + partition
   column scan, semi-joined with the day's keys) plus the partitions the day's
   rows belong to. One value per partition, so its size is bounded by the
   partition count, not by the data.
2. The target restricted to ``touched`` (partition pruning) is merged with the
   day by ``merge_upsert`` and written, partitioned, to a fresh version folder.
3. Each touched partition is pointed at its new folder (``ALTER TABLE ...
   PARTITION (...) SET LOCATION``), added if new, dropped if it ended empty.
   Untouched partitions keep their files and locations.

A record whose partition value changes (its source column was edited) moves:
its old partition is touched through step 1, so it is rewritten without it.
Each partition switch is one catalog call; readers see every partition either
before or after the merge.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import c, q
from ..operators.merge import day_key_test, merge_upsert
from .tables import as_nullable, version_path

NO_PARTITION = "none"
_SAFE = re.compile(r"^[A-Za-z0-9_.\-]+$")


def partition_value(source: Column, pattern: str) -> Column:
    """Partition of a row: its source time formatted by ``pattern``; ``none`` when null."""
    return F.coalesce(F.date_format(source, pattern), F.lit(NO_PARTITION))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{q(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def _check_values(values) -> None:
    bad = [v for v in values if v is None or not _SAFE.match(v)]
    if bad:
        raise ValueError(f"partition values must be plain text (letters, digits, . _ -): {bad[:5]}")


def _partition_order(df: DataFrame, part_col: str) -> DataFrame:
    """Partition column last, as a partitioned table stores it."""
    return df.select(*[c(n) for n in df.columns if n != part_col], c(part_col))


def _clustered(df: DataFrame, part_col: str) -> DataFrame:
    """Rows grouped by partition value before a partitioned write.

    Unclustered, every task writes a file into every partition it holds
    (tasks x partitions small files). The ``rebalance`` hint shuffles by the
    partition value and lets AQE coalesce small partitions and split a
    partition holding a large share of the rows, so files come out near the
    advisory size and no task writes a whole hot partition.
    """
    return df.hint("rebalance", part_col)


def publish_partitioned(spark: SparkSession, df: DataFrame, name: str, root: str, part_col: str, mark: str = "") -> str:
    """Write all rows as a new partitioned version and (re)create the table over it.

    The new catalog entry is built under a staging name (create, recover the
    partitions: a listing of the whole version), and only then swapped in by
    a drop and a rename, so readers lose the table for two catalog calls, not
    for the listing. The old version's files stay.
    """
    df = _partition_order(df, part_col)
    path = version_path(root, mark)
    _clustered(df, part_col).write.mode("errorifexists").partitionBy(part_col).parquet(path)
    staging = f"{name}__p{uuid.uuid4().hex[:8]}"
    spark.sql(
        f"CREATE TABLE IDENTIFIER(:t) ({_ddl(as_nullable(df.schema))}) USING parquet "
        f"PARTITIONED BY ({q(part_col)}) LOCATION :loc",
        args={"t": staging, "loc": path},
    )
    spark.sql("ALTER TABLE IDENTIFIER(:t) RECOVER PARTITIONS", args={"t": staging})
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})
    spark.sql("ALTER TABLE IDENTIFIER(:s) RENAME TO IDENTIFIER(:t)", args={"s": staging, "t": name})
    return path


def table_partitions(spark: SparkSession, name: str, part_col: str) -> set[str]:
    rows = spark.sql("SHOW PARTITIONS IDENTIFIER(:t)", args={"t": name}).collect()
    prefix = f"{part_col}="
    return {r[0][len(prefix):] for r in rows if r[0].startswith(prefix)}


def _written(spark: SparkSession, path: str, part_col: str, schema: T.StructType) -> set[str]:
    """Partition values that received files under ``path`` (from the file listing)."""
    files = spark.read.schema(schema).parquet(path).inputFiles()
    found = set()
    for f in files:
        for seg in f.split("/"):
            if seg.startswith(f"{part_col}="):
                found.add(seg[len(part_col) + 1:])
    return found


def marked_partitions(rows: DataFrame, part_col: str, mark: str) -> set[str]:
    """Partition values whose files lie in a version folder that ends with ``mark`` (from the file listing)."""
    found = re.compile(rf"{re.escape(mark)}/{re.escape(part_col)}=([^/]+)/")
    return {m.group(1) for f in rows.inputFiles() if (m := found.search(f))}


def touched_partitions(target: DataFrame, day: DataFrame, key: str, part_col: str, day_rows: int | None = None) -> list[str]:
    """Partitions holding a day key in the target, plus those the day's rows go to.

    Target keys that the day's filter rejects stay where they are; the others'
    (key, partition) pairs are made distinct map-side, so a hot target key
    crosses the network once per task and partition, not once per row.
    """
    day_keys = day.select(c(key).alias("__tl_k")).where(F.col("__tl_k").isNotNull())
    pairs = target.select(c(key).alias("__tl_k"), c(part_col).alias("__tl_p")).where(F.col("__tl_k").isNotNull())
    test = day_key_test(target, day, key, day_rows)
    if test:
        pairs = pairs.where(test(F.col("__tl_k")))
    held = pairs.distinct().join(day_keys, "__tl_k", "left_semi").select("__tl_p")
    parts = held.unionByName(day.select(c(part_col).alias("__tl_p"))).distinct()
    return sorted(r["__tl_p"] for r in parts.collect())


def upsert_partitions(spark: SparkSession, table: str, day: DataFrame, key: str, part_col: str,
                      root: str, day_rows: int | None = None, mark: str = "") -> list[str]:
    """Merge ``day`` (which carries ``part_col``) into partitioned ``table``; rewrite touched partitions only.

    A merge with a ``mark`` that broke off is taken up where it stopped:
    partitions that already lie in a folder so marked hold their part of the
    day and are left alone, and so are the day's rows that belong there.
    """
    target = spark.table(table)
    day = day.select(*[c(n) for n in target.columns])
    touched = touched_partitions(target, day, key, part_col, day_rows)
    done = marked_partitions(target.where(c(part_col).isin(touched)), part_col, mark) if mark and touched else set()
    touched = [v for v in touched if v not in done]
    if not touched:
        return []
    _check_values(touched)
    old = target.where(c(part_col).isin(touched))
    merged = _partition_order(merge_upsert(old, day, key, check_unique=False, day_rows=day_rows), part_col)
    if done:
        merged = merged.where(~c(part_col).isin(sorted(done)))
    path = version_path(root, mark)
    _clustered(merged, part_col).write.mode("errorifexists").partitionBy(part_col).parquet(path)
    written = _written(spark, path, part_col, as_nullable(merged.schema))
    existing = table_partitions(spark, table, part_col)
    for v in touched:
        args = {"t": table, "v": v, "loc": f"{path}/{part_col}={v}"}
        if v in written and v in existing:
            spark.sql(f"ALTER TABLE IDENTIFIER(:t) PARTITION ({q(part_col)} = :v) SET LOCATION :loc", args=args)
        elif v in written:
            spark.sql(f"ALTER TABLE IDENTIFIER(:t) ADD PARTITION ({q(part_col)} = :v) LOCATION :loc", args=args)
        elif v in existing:
            spark.sql(f"ALTER TABLE IDENTIFIER(:t) DROP PARTITION ({q(part_col)} = :v)", args={"t": table, "v": v})
    spark.catalog.refreshTable(table)
    return touched
