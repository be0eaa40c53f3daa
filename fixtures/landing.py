"""Write records as landed page documents (the API side, for fixtures and replays).

Fetching pages over HTTP is outside the package; pages arrive as files. This
writer, which belongs to the tests and driver queries, produces the same envelope from a DataFrame so the load path can be
driven from tables. A page holds the records whose ``page_of`` value is
equal (``floor(id / 1000)`` for pages of 1,000 ids). A page may arrive as
several documents with the same page number, link and stop flag: records are
cut into runs of at most ``max_records`` consecutive rows of one input
partition, so no document grows with the data, even when one key holds a
third of all rows. The cut needs no count and no extra pass.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.functions.casts import c
from tableload.operators.links import link_key
from tableload.sources.pages import BLOCK_PAGES, HEADERS, PAGE_BLOCK

#: Seconds spent landing pages so far, so that the bench can time operators apart from their fixtures.
SPENT = {"sec": 0.0}


def nest(flat: DataFrame) -> DataFrame:
    """Dotted top-level columns -> nested structs (inverse of ``record_flatten``)."""
    tree: dict = {}
    for name in flat.columns:
        node = tree
        parts = name.split(".")
        for p in parts[:-1]:
            node = node.setdefault(p, {})
            if not isinstance(node, dict):
                raise ValueError(f"{name!r} nests under a leaf column")
        node[parts[-1]] = name

    def build(node: dict) -> list[Column]:
        out = []
        for key, child in node.items():
            if isinstance(child, dict):
                out.append(F.struct(*build(child)).alias(key))
            else:
                out.append(c(child).alias(key))
        return out

    return flat.select(*build(tree))


def to_wire_text_times(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text (lossless micros), as an API would send them."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            cols.append(F.date_format(c(f.name), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(f.name))
        else:
            cols.append(c(f.name))
    return df.select(*cols)


def row_run(max_rows: int) -> Column:
    """Label runs of at most ``max_rows`` consecutive rows of one input partition.

    ``monotonically_increasing_id`` gives distinct integers (the partition in
    the high bits, the row's position in it below), so a block of
    ``max_rows`` consecutive values, ``id div max_rows``, holds at most
    ``max_rows`` rows, and in practice rows of one partition only. Adding it
    to a grouping key bounds every group without a count or an extra pass.
    """
    if max_rows < 1:
        raise ValueError("max_rows must be positive")
    return F.expr(f"monotonically_increasing_id() div {int(max_rows)}")


def land_pages(
    records: DataFrame,
    array_field: str,
    out_dir: str,
    page_of: Column,
    link_field: str = "next_page",
    link_base: str = "https://example.invalid/api/v2/incremental?start_time=",
    stop_page: int | None = None,
    max_records: int = 1000,
    request_field: str | None = None,
    headers: bool = False,
    blocks: bool = False,
) -> str:
    """Group records into pages and write them as JSON documents (JSON lines).

    ``headers`` writes the header set beside them and ``blocks`` one folder for
    every ``BLOCK_PAGES`` page numbers. With ``request_field`` the pages carry no numbers but
    opaque cursors: the one they answer and the next one (the last page's leads on
    to a page not fetched yet).

    ``end_of_stream`` is set on the last page, and also on ``stop_page`` when
    given (pages after it then model a later, stale fetch). Each writer task
    lands its pages as one file. Each document holds at most ``max_records``
    records (``row_run``).
    """
    rec = F.struct(*[c(n) for n in records.columns])
    run = row_run(max_records)
    pages = (
        records.select(page_of.alias("page"), run.alias("__tl_run"), rec.alias("__tl_rec"))
        .groupBy("page", "__tl_run")
        .agg(F.collect_list("__tl_rec").alias(array_field))
    )
    last = records.select(F.max(page_of)).scalar()
    eos = F.col("page") == last
    if stop_page is not None:
        eos = eos | (F.col("page") == F.lit(stop_page))
    link = F.when(eos, F.lit(None).cast("string")).otherwise(F.concat(F.lit(link_base), (F.col("page") + 1).cast("string")))
    place = F.col("page")
    if request_field:
        cursor = [F.sha1(F.concat(F.lit("page"), (F.col("page") + step).cast("string"))) for step in (0, 1)]
        link = cursor[1]
        first = records.select(F.min(page_of)).scalar()
        asked = F.when(F.col("page") == first, F.concat(F.lit(link_base), F.lit("0"))).otherwise(F.concat(F.lit(link_base), F.lit("0&cursor="), cursor[0]))
        place = asked.alias(request_field)
    block = [F.floor(F.col("page") / BLOCK_PAGES).cast("int").alias(PAGE_BLOCK)] if blocks else []
    began = time.perf_counter()
    if headers:
        # the lander keeps a row a document as it writes the page; here they are counted again
        keys = records.select(page_of.alias("page")).distinct()
        own = F.lit(None).cast("string") if not request_field else link_key(asked)
        number = F.col("page") if not request_field else F.col("page") - first
        keys.select(number.alias("page"), own.alias("own"), eos.alias("end_of_stream")).write.parquet(f"{out_dir}/{HEADERS}")
    pages = pages.select(array_field, link.alias(link_field), eos.alias("end_of_stream"), place, *block)
    if blocks:
        pages.hint("rebalance", PAGE_BLOCK).write.mode("append").partitionBy(PAGE_BLOCK).json(out_dir)
    else:
        pages.write.mode("append" if headers else "errorifexists").json(out_dir)
    SPENT["sec"] += time.perf_counter() - began
    return out_dir
