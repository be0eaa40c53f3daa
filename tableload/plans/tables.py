"""Tables: versioned publish, create-like, row inserts, scripts with bound values.

A table is a catalog entry pointing at one immutable Parquet folder. A new
state is written to a fresh ``v=...`` folder first and the table is switched
to it afterwards, so a failed write leaves the old state readable (dropping
first, then copying, would leave an empty table behind). Readers of the old
version are never overwritten under their feet.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.flatten import conform_columns


def version_path(root: str, mark: str = "") -> str:
    """A fresh version folder; ``mark`` (letters, digits, ``-``) ends its name and is switched to with the data."""
    return f"{root.rstrip('/')}/v={time.time_ns():020d}-{uuid.uuid4().hex[:8]}{mark}"


def table_location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": name}).collect()
    for r in rows:
        if r["col_name"] == "Location":
            return r["data_type"]
    return None


def publish(spark: SparkSession, df: DataFrame, name: str, root: str, mark: str = "") -> str:
    """Write ``df`` as a new version under ``root`` and point table ``name`` at it.

    Same schema: ``ALTER TABLE ... SET LOCATION`` (one catalog call). Changed
    schema (a reset): the external table entry is dropped and created again;
    data folders outlive the drop.
    """
    path = version_path(root, mark)
    df.write.mode("errorifexists").parquet(path)
    schema = as_nullable(df.schema)  # what Parquet stores; no footer re-read, no inference job
    if spark.catalog.tableExists(name):
        if same_shape(spark.table(name).schema, schema):
            spark.sql("ALTER TABLE IDENTIFIER(:t) SET LOCATION :loc", args={"t": name, "loc": path})
            spark.catalog.refreshTable(name)
            return path
        spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": name})
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return path


def as_nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def same_shape(a: T.StructType, b: T.StructType) -> bool:
    """Same names, order and types (nullability aside)."""
    return [(f.name, f.dataType.simpleString()) for f in a.fields] == [
        (f.name, f.dataType.simpleString()) for f in b.fields
    ]


def table_recreate(spark: SparkSession, name: str, schema: T.StructType, root: str) -> str:
    """Empty table with the declared schema (``drop``; ``create table (...)``)."""
    return publish(spark, spark.createDataFrame([], schema), name, root)


def table_like(spark: SparkSession, like: str) -> T.StructType:
    """Schema of an existing table (``create table d like t``); missing table raises."""
    return spark.table(like).schema


def load_like(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows placed into a ``LIKE`` table: by name, cast to its types.

    A column the rows lack, or one they carry in a type the table does not
    have, is a schema change and fails (the caller then reloads in full).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"rows lack table columns {missing}")
    changed = [f.name for f in schema.fields if have[f.name] != f.dataType]
    if changed:
        raise ValueError(f"columns changed type against the table: {changed}")
    return conform_columns(df, schema)


def insert_rows(frames: list[DataFrame], columns: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows of several inserts, each matched to the column list by name, stacked."""
    out = None
    for f in frames:
        part = f.select(*[f"`{c}`" for c in columns])
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no rows to insert")
    return out


def script_commit(spark: SparkSession, statements: list[tuple[str, dict]], name: str, root: str,
                  sources: dict[str, DataFrame] | None = None) -> str:
    """Run every row-producing statement, then publish all rows with one write.

    Each statement is ``(sql, args)`` with ``:name`` markers bound from
    ``args``; ``{name}`` in the text refers to a frame in ``sources``. Nothing
    is visible until the single publish at the end, so a failing statement
    leaves the table as it was.
    """
    sources = sources or {}
    frames = []
    for sql, args in statements:
        used = {k: v for k, v in sources.items() if "{" + k + "}" in sql}
        frames.append(spark.sql(sql, args=args or None, **used))
    columns = frames[0].columns
    return publish(spark, insert_rows(frames, columns), name, root)


def script_publish(spark: SparkSession, text: str, name: str, root: str, args: dict,
                   sources: dict[str, DataFrame] | None = None) -> str:
    """Run a SQL script (one text, ``BEGIN ... END``, with its variables) and publish what it made of its table.

    The script calls its table ``IDENTIFIER(:target)`` and a frame in ``sources``
    ``IDENTIFIER(:<its name>)``; other ``:name`` markers are bound values. It works on a
    staging table, which is published with one write after its last
    statement: a failing statement leaves ``name`` as it was, however many ran before it.
    """
    run = uuid.uuid4().hex[:8]
    staging = f"{name}__s{run}"
    views = {k: f"tl_{k}_{run}" for k in sources or {}}
    for k, view in views.items():
        sources[k].createOrReplaceTempView(view)
    used = {k: v for k, v in {**args, "target": staging, **views}.items() if re.search(rf":{k}\b", text)}
    try:
        spark.sql(text, args=used or None)
        if not spark.catalog.tableExists(staging):
            raise ValueError("the script made no table IDENTIFIER(:target)")
        return publish(spark, spark.table(staging), name, root)
    finally:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": staging})
        for view in views.values():
            spark.catalog.dropTempView(view)
