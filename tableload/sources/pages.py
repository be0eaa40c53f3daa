"""Landed page documents: read, stop at end of stream, one day's records.

A page is one JSON document: the record array under the object's name, the
next link (``next_page`` or ``after_cursor``), ``end_of_stream`` and the
``page`` sequence number the lander wrote. Pages are read with an explicit
envelope schema (never inferred: on mixed pages inference guesses wrong) in
``FAILFAST`` mode, so a wrong-typed field fails the load instead of becoming
null. JSON-lines files (one page per line) split by byte range, so all pages
are read in parallel; ``multi_line`` reads one pretty-printed page per file
(one task per file).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import c, day_start, end_of_day, typed_value
from ..operators.flatten import conform_columns, leaves, record_explode, record_flatten
from ..operators.links import link_key, order_links
from ..schemas import ObjectSpec, _WIRE
from ..session import path_exists

#: Folder of a landing with its header set; Spark's readers of the pages pass it over.
HEADERS = "_headers"
HEADER_ROWS = T.StructType([T.StructField("page", T.LongType()), T.StructField("own", T.StringType()), T.StructField("end_of_stream", T.BooleanType())])
#: A landing may be split into folders ``page_block=<n>`` of so many page numbers.
PAGE_BLOCK, BLOCK_PAGES = "page_block", 64
#: How variants hold JSON numbers with a fraction, by their digits.
_FRACTIONS = (T.DecimalType, T.DoubleType, T.FloatType)


def envelope_guard(pages: DataFrame, array_field: str, place: str = "page") -> DataFrame:
    """Fail the load on a page without its record array (a bad response) or
    without its sequence number (it could not be ordered against the stop page,
    and would otherwise be dropped silently)."""
    # guard the columns themselves: a filter on ``page`` (page_stop) then still
    # sees the check, even when Catalyst moves the filter below this projection
    if place == "page":
        page = F.when(F.col("page").isNull(), F.raise_error(F.lit("page without a sequence number"))).otherwise(F.col("page"))
        pages = pages.withColumn("page", page)
    return pages.withColumn(
        array_field,
        F.when(
            c(array_field).isNull(),
            F.raise_error(F.concat(F.lit(f"page without '{array_field}' records, page "), F.coalesce(c(place).cast("string"), F.lit("")))),
        ).otherwise(c(array_field)),
    )


def read_pages(spark: SparkSession, path: str, envelope: T.StructType, multi_line: bool = False) -> DataFrame:
    return (
        spark.read.schema(envelope)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .json(path)
    )


def page_headers(pages: DataFrame, spec: ObjectSpec) -> DataFrame:
    """(page, own, end_of_stream) of every page document.

    Pages without numbers are put in the order of their links; ``own`` is the
    key of the link that a page answers.
    """
    if not spec.request_field:
        return pages.select("page", F.lit(None).cast("string").alias("own"), "end_of_stream")
    links = pages.select(link_key(c(spec.request_field)).alias("own"), link_key(c(spec.link_field)).alias("next"), F.col("end_of_stream").alias("ended"))
    links = links.withColumn("next", F.when(F.col("next") != "", F.col("next")))
    ends = links.groupBy("own").agg(F.max("ended").alias("end_of_stream"))
    return order_links(links).join(ends, "own").select("page", "own", "end_of_stream")


def store_headers(spark: SparkSession, spec: ObjectSpec, path: str, multi_line: bool = False) -> str:
    """Write the header set of a landing beside its pages: a few bytes a page, as a lander does that keeps them itself.

    Only for landings that came without one: it takes a scan of the pages
    (their records are skipped, not parsed).
    """
    out = f"{path.rstrip('/')}/{HEADERS}"
    page_headers(read_pages(spark, path, spec.header_schema(), multi_line), spec).write.mode("overwrite").parquet(out)
    return out


def read_headers(spark: SparkSession, path: str) -> DataFrame | None:
    """The header set of a landing, or None where it has none."""
    folder = f"{path.rstrip('/')}/{HEADERS}"
    return spark.read.schema(HEADER_ROWS).parquet(folder) if path_exists(spark, folder) else None


def page_source(spark: SparkSession, spec: ObjectSpec, path: str, multi_line: bool = False, headers: DataFrame | None = None) -> DataFrame:
    """All landed pages of one object, guarded and numbered.

    A landing without page numbers gets them from the links: from its header
    set (``headers``), else from the pages' own headers. The numbers are narrow and joined by Spark's own size check,
    so the records stay where they are unless the landing has very many pages.
    """
    pages = envelope_guard(read_pages(spark, path, spec.envelope_schema(), multi_line), spec.name, spec.request_field or "page")
    if not spec.request_field:
        return pages
    if headers is None:
        headers = page_headers(read_pages(spark, path, spec.header_schema(), multi_line), spec)
    numbers = headers.select("own", "page")
    return pages.withColumn("own", link_key(c(spec.request_field))).join(numbers, "own", "left").drop("own")


def page_stop(pages: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Pages up to and including the first one flagged ``end_of_stream``.

    The stop page is a scalar subquery (one aggregate over the page flags,
    planned by Spark as a separate small job); no page is flagged -> keep all.
    With the landing's header set the flags are read there and the pages are
    scanned once; folders of page numbers after the stop (``PAGE_BLOCK``) are not read at all.
    """
    flagged = (pages if headers is None else headers).where(F.col("end_of_stream"))
    stop = flagged.select(F.min("page")).scalar()
    kept = stop.isNull() | (F.col("page") <= stop)
    if PAGE_BLOCK in pages.columns:
        block = flagged.select(F.floor(F.min("page") / BLOCK_PAGES)).scalar()
        return pages.where(block.isNull() | (F.col(PAGE_BLOCK) <= block)).where(kept)
    return pages.where(kept)


def landed_pages(spark: SparkSession, spec: ObjectSpec, path: str, multi_line: bool = False) -> DataFrame:
    """The pages of a landing up to its stop, its header set used where it has one."""
    headers = read_headers(spark, path)
    return page_stop(page_source(spark, spec, path, multi_line, headers), headers)


def flat_records(pages: DataFrame, spec: ObjectSpec, keep: list[str] | None = None) -> DataFrame:
    """Pages -> records with dotted columns, and the page columns in ``keep``.

    A column that is an object in one record and a plain value in the next
    (``photo``) gives its dotted columns in the first and its own in the second.
    """
    records = record_explode(pages, spec.name, keep)
    for name, schema in spec.text_or_object().items():
        is_object = c(name).startswith("{")
        records = records.withColumns(
            {f"__tl_{name}": F.when(is_object, F.from_json(c(name), schema)), name: F.when(~is_object, c(name))}
        )
    flat = record_flatten(records)
    return flat.withColumnsRenamed({n: n.removeprefix("__tl_") for n in flat.columns if "." in n and n.startswith("__tl_")})


def wire_records(pages: DataFrame, spec: ObjectSpec) -> DataFrame:
    """Pages -> flat records in the spec's column list, wire types."""
    return conform_columns(flat_records(pages, spec), wire_schema(spec))


def wire_schema(spec: ObjectSpec) -> T.StructType:
    return T.StructType([T.StructField(col.name, _WIRE[col.kind], True) for col in spec.columns])


def wire_keys(records: DataFrame, column: str = "record") -> list[tuple[tuple[str, ...], str]]:
    """(names from the top, wire type) of every key that some record carries, from one schema aggregate over variants.

    Objects are taken apart, lists are one value, "number" is one with a fraction. A key with different kinds of values has type VARIANT,
    one that is an object here and a value there is listed as it is, and its members are not.
    """
    text = records.agg(F.schema_of_variant_agg(column)).first()[0]
    if not text.startswith("OBJECT<"):
        return []
    struct = T.StructType.fromDDL("r " + re.sub(r"(`[^`]*`)|\bOBJECT<", lambda m: m.group(1) or "STRUCT<", text))[0].dataType
    return [(path, "number" if isinstance(kind, _FRACTIONS) else kind.simpleString()) for path, kind in leaves(struct)]


def wire_report(spark: SparkSession, spec: ObjectSpec, path: str) -> DataFrame:
    """(column_name, finding, wire_type, n_records) of a landing against the column contract.

    Records are read as variants, so every key there is, is seen: "kept" is a
    key of the contract that records carry, "extra" one that the load drops, "absent" a column that no
    record carries (it loads as null). ``n_records`` carry a value that is not null (null for a name with both kinds of quotes). Two aggregates, each
    of one row a task.
    """
    envelope = T.StructType([T.StructField(spec.name, T.ArrayType(T.VariantType()))])
    records = spark.read.schema(envelope).option("mode", "FAILFAST").json(path).select(F.explode(c(spec.name)).alias("record"))
    found = wire_keys(records)

    def held(path: tuple[str, ...]) -> Column:
        if any("'" in x and '"' in x for x in path):  # no path can be written for such a name
            return F.lit(None).cast("long")
        steps = "".join(f"['{x}']" if "'" not in x else f'["{x}"]' for x in path)
        value = F.try_variant_get("record", "$" + steps, "variant")
        return F.count_if(value.isNotNull() & ~F.is_variant_null(value))

    counts = records.agg(*[held(path).alias(str(i)) for i, (path, _) in enumerate(found)]).first() if found else ()
    found = [(".".join(path), kind) for path, kind in found]
    names = set(spec.names)
    rows = [(name, "kept" if name in names else "extra", kind, n) for (name, kind), n in zip(found, counts, strict=True)]
    rows += [(name, "absent", None, 0) for name in spec.names if name not in {n for n, _ in found}]
    return spark.createDataFrame(rows, "column_name string, finding string, wire_type string, n_records long")


def record_time(spec: ObjectSpec) -> Column:
    """The record clock as ``timestamp_ntz`` from its wire text; a bad clock fails the load."""
    return typed_value(c(spec.time_column), spec.kind(spec.time_column), spec.time_column)


def day_bounds(ds: str, zone: str = "UTC") -> tuple[Column, Column]:
    """[start, end) of day ``ds`` in ``zone``, as UTC wall clock (constant-folded)."""
    lo, hi = day_start(ds), end_of_day(ds)
    if zone.upper() != "UTC":
        lo = F.convert_timezone(F.lit(zone), F.lit("UTC"), lo)
        hi = F.convert_timezone(F.lit(zone), F.lit("UTC"), hi)
    return lo, hi


def full_source(spark: SparkSession, spec: ObjectSpec, path: str, since: str = "1970-01-01",
                multi_line: bool = False) -> DataFrame:
    """Full extract: pages up to end of stream, records from ``since`` on.

    A record without a clock value cannot be placed in time; a full load
    keeps it rather than dropping it silently.
    """
    pages = landed_pages(spark, spec, path, multi_line)
    recs = wire_records(pages, spec)
    if spec.time_column is None:
        return recs
    t = record_time(spec)
    return recs.where(t.isNull() | (t >= day_start(since)))


def daily_source(spark: SparkSession, spec: ObjectSpec, path: str, ds: str, zone: str = "UTC",
                 multi_line: bool = False, by_clock: bool = False) -> DataFrame:
    """One day's records (all pages of the day, not just the first).

    ``path`` is the day's own landing: its response is the day, so every record
    is kept, whatever its clock says. ``by_clock`` is for a landing that is not
    split by day: records are kept by their clock (those without one too,
    since they cannot be placed elsewhere).
    """
    pages = landed_pages(spark, spec, path, multi_line)
    recs = wire_records(pages, spec)
    if not by_clock:
        return recs
    if spec.time_column is None:
        raise ValueError(f"{spec.name} has no clock column; its landing must be split by day")
    lo, hi = day_bounds(ds, zone)
    t = record_time(spec)
    return recs.where(t.isNull() | ((t >= lo) & (t < hi)))
