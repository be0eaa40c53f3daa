"""Merge landed page fetches into a table as they arrive (Structured Streaming).

The batch loader merges one calendar day on request. Here the same steps run
per micro-batch of a file stream over the landing folder. A fetch (one
pagination run) is a folder of JSON-lines files, e.g. ``fetch=000123/``, so
several writers can land it; it must be committed as a whole (written aside,
then renamed). A micro-batch takes everything landed since the previous one -
a cap on files could cut a folder apart - and merges it
**once**: each fetch is cut at its own end-of-stream page, then the
fetches are folded into one day of rows, the latest fetch winning per key,
which equals merging them one after the other:

* a key in several fetches takes the latest fetch's row (landing order: last
  file modification time, then path, the order the file stream itself uses);
* a key twice in one fetch fails the batch (the daily rule);
* null keys never match, so null-key rows of every fetch are inserted.

One merge per batch rather than per fetch matters at scale: every merge
publishes a new table version (the whole table, or the touched partitions),
so a burst of small fetches costs one rewrite, not one each. A key appears at
most once per fetch, so a fold group holds at most one row for each fetch of
the batch, and its aggregates combine map-side.

The stream checkpoint records which files were merged, so a restart continues
where it stopped. A batch that is run again is skipped when the table already
holds it: the number of the stream's last merged batch ends the name of the
table's version folder, so it is switched to with the data. (Merging keyed rows
twice changes nothing, but rows with a null key would be inserted again.) A
partitioned table's folders carry it partition by partition: a batch that broke off is
taken up with the partitions it had not reached, and a table property
says that it reached all. The first batch creates the table when it does not exist yet.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.casts import c, wire_value
from ..operators.flatten import conform_columns
from ..plans.pipelines import LoadPaths, apply_day
from ..schemas import ObjectSpec
from ..sources.pages import envelope_guard, flat_records, wire_schema
from ..sources.stage import stage_and_load
from ..plans.tables import table_location

FETCH = "__tl_fetch"  # folder of the fetch a page came from
LANDED = "__tl_landed"  # modification time of the page's file
BATCH = "tableload.stream.batch"  # property of a partitioned table: mark of the last batch merged into all its partitions


def fetch_stop(pages: DataFrame) -> DataFrame:
    """Pages of each fetch up to and including that fetch's first end-of-stream page.

    The stop table has one row per fetch in the batch; Spark broadcasts it by
    its own size check, and splits a large fetch otherwise.
    """
    stops = pages.where(F.col("end_of_stream")).groupBy(FETCH).agg(F.min("page").alias("__tl_stop"))
    kept = pages.join(stops, FETCH, "left")
    return kept.where(F.col("__tl_stop").isNull() | (F.col("page") <= F.col("__tl_stop"))).drop("__tl_stop")


def fold_fetches(records: DataFrame, key: str, columns: list[str], kind: str = "string") -> DataFrame:
    """Records of several fetches -> the rows one merge must apply (latest fetch per key).

    Keys are compared by value of their ``kind``: ``123`` and ``123.0`` are one id.
    """
    rec = F.struct(*[c(n) for n in columns])
    folded = (
        records.where(c(key).isNotNull())
        .groupBy(wire_value(c(key), kind).alias("__tl_k"))
        .agg(
            F.count(F.lit(1)).alias("__tl_n"),
            # the fetches holding the key, at most those of the batch; one
            # shuffle, where a distinct count would shuffle the records twice
            F.size(F.collect_set(FETCH)).alias("__tl_nf"),
            F.max_by(rec, F.struct(LANDED, FETCH)).alias("__tl_r"),
        )
    )
    checked = folded.select(
        F.when(
            F.col("__tl_n") > F.col("__tl_nf"),
            F.raise_error(F.concat(F.lit(f"duplicate {key} in one fetch: "), F.col("__tl_k").cast("string"))),
        )
        .otherwise(F.col("__tl_r"))
        .alias("__tl_r")
    ).select(*[F.col("__tl_r").getField(n).alias(n) for n in columns])
    nulls = records.where(c(key).isNull()).select(*[c(n) for n in columns])
    return checked.unionByName(nulls)


def fetch_records(pages: DataFrame, spec: ObjectSpec) -> DataFrame:
    """Guarded pages of several fetches -> flat wire records carrying their fetch."""
    kept = fetch_stop(envelope_guard(pages, spec.name))
    flat = flat_records(kept, spec, keep=[FETCH, LANDED])
    schema = T.StructType(
        wire_schema(spec).fields
        + [T.StructField(FETCH, T.StringType()), T.StructField(LANDED, T.TimestampType())]
    )
    return conform_columns(flat, schema)


def batch_mark(stream: str, batch_id: int | str) -> str:
    """End of a version folder's name: which stream's batch it holds."""
    return f"-s{zlib.crc32(stream.encode()):08x}b{batch_id}"


def merged_batch(spark: SparkSession, table: str, stream: str) -> int:
    """The last batch of the stream that the whole table holds, -1 before the first."""
    said = [table_location(spark, table) or ""]
    said += [r["value"] for r in spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:t)", args={"t": table}).collect() if r["key"] == BATCH]
    ends = [re.search(batch_mark(stream, r"(\d+)$"), s) for s in said]
    return max([int(m.group(1)) for m in ends if m], default=-1)


def merge_fetches(spark: SparkSession, spec: ObjectSpec, pages: DataFrame, paths: LoadPaths, table: str,
                  batch_id: int, stream: str = "") -> None:
    """One micro-batch: pages of the fetches landed since the last one -> one merged version.

    ``stream`` names the checkpoint whose batch numbers these are.
    """
    if spark.catalog.tableExists(table) and merged_batch(spark, table, stream) >= batch_id:
        return
    records = fetch_records(pages, spec)
    day = fold_fetches(records, spec.key, spec.names, spec.kind(spec.key))
    stage = f"{paths.stage}/{spec.name}/batch={batch_id:010d}"
    typed = stage_and_load(spark, day, spec, stage)
    mark = batch_mark(stream, batch_id)
    apply_day(spark, spec, typed, paths, table, create_if_missing=True, mark=mark)
    if spec.partition:
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET TBLPROPERTIES ('{BATCH}' = '{mark}')", args={"t": table})


def stream_load(spark: SparkSession, spec: ObjectSpec, landing_dir: str, paths: LoadPaths, table: str,
                checkpoint: str | None = None, available_now: bool = True,
                processing_time: str = "5 minutes") -> StreamingQuery:
    """Start the stream; with ``available_now`` it drains what has landed and stops."""
    checkpoint = checkpoint or f"{paths.tables}/_checkpoints/{table}"
    source = (
        spark.readStream.schema(spec.envelope_schema())
        .option("mode", "FAILFAST")
        .json(landing_dir)
        .select(
            *[c(f.name) for f in spec.envelope_schema().fields],
            F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias(FETCH),
            F.col("_metadata.file_modification_time").alias(LANDED),
        )
    )
    writer = source.writeStream.foreachBatch(
        lambda batch, batch_id: merge_fetches(batch.sparkSession, spec, batch, paths, table, batch_id, checkpoint)
    ).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def drain(spark: SparkSession, query: StreamingQuery, table: str) -> DataFrame:
    """Wait for an available-now stream, fail on its error, read the table fresh.

    Micro-batches run in the stream's own (cloned) session; the caller's
    session may still hold the table's previous location, so it is refreshed.
    """
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream for {table} failed: {query.exception()}")
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
    return spark.table(table)
