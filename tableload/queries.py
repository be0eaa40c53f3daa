"""Driver queries over /root/testdata tables, each with its DuckDB oracle.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables. Queries whose operator is a write (stage, table, landing) do the
write under the session's scratch root and return the read-back frame.
Output columns are scalar (lists as JSON text) so value hashes are exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures.landing import land_pages, nest, row_run, to_wire_text_times

from .functions.casts import (
    c,
    day_start,
    end_of_day,
    from_epoch,
    length_violations,
    link_param,
    strip_prefix,
    table_columns_from_wire,
    text_columns,
    to_epoch,
    to_int,
)
from .operators.flatten import conform_columns, record_explode, record_flatten, union_pages
from .operators.window import daily_window, since_start
from .plans.pipelines import (
    DEMO_SCRIPT,
    LoadPaths,
    full_load,
    incremental_load,
    load_all_objects,
    load_with_fallback,
    script_load,
    script_text_load,
)
from .plans.buckets import publish_bucketed
from .plans.partitions import partition_value, publish_partitioned, upsert_partitions
from .plans.tables import insert_rows, load_like, publish, table_like, table_recreate
from .schemas import DEMO_COLUMNS, DEMO_LITERAL_ROWS, DEMO_PARAMS, ObjectSpec, object_spec, parse_columns
from .session import scratch_dir
from .streaming.landing import drain, stream_load
from .sources.literal import bound_rows
from .sources.pages import daily_source, landed_pages, page_source, wire_records, wire_report
from .sources.stage import csv_stage_scan, csv_stage_write, stage_and_load, stage_path, typed_load
from .operators.merge import (
    assert_unique_keys,
    merge_insert_unmatched,
    merge_match,
    merge_update_matched,
    merge_upsert,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# --------------------------------------------------------------------------
# merge family on orders. Target: orders before 2001-07-01. Day: orders from
# 2001-06-15 on, re-sent with status cleared (null must overwrite) and price
# + 1. The overlap updates, the rest inserts.
# --------------------------------------------------------------------------

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

_MERGE_CTE = f"""
WITH t AS (SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01 00:00:00'),
d AS (SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus,
             o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-15 00:00:00')
"""

_MERGE_BODY = """
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = t.o_orderkey)
UNION ALL
SELECT d.* FROM t JOIN d ON t.o_orderkey = d.o_orderkey
UNION ALL
SELECT d.* FROM d WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = d.o_orderkey)
"""


def _orders_target(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderdate") < ntz("2001-07-01 00:00:00"))


def _orders_day(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderdate") >= ntz("2001-06-15 00:00:00")).select(
        "o_orderkey",
        "o_custkey",
        F.lit(None).cast("string").alias("o_orderstatus"),
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )


@register("merge_upsert", _MERGE_CTE + _MERGE_BODY)
def q_merge_upsert(spark, sf_dir):
    return merge_upsert(_orders_target(spark, sf_dir), _orders_day(spark, sf_dir), "o_orderkey")


@register(
    "merge_upsert_duplicates",
    f"""
WITH t1 AS (SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01 00:00:00'),
t AS (SELECT * FROM t1 UNION ALL SELECT * FROM t1),
d AS (SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus,
             o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-15 00:00:00')
"""
    + _MERGE_BODY,
)
def q_merge_upsert_duplicates(spark, sf_dir):
    # every target key twice: both copies must be updated, none collapsed
    t = _orders_target(spark, sf_dir)
    return merge_upsert(t.unionByName(t), _orders_day(spark, sf_dir), "o_orderkey")


@register(
    "merge_update_matched",
    _MERGE_CTE
    + """
SELECT CASE WHEN d.o_orderkey IS NOT NULL THEN d.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
       CASE WHEN d.o_orderkey IS NOT NULL THEN d.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN d.o_orderkey IS NOT NULL THEN d.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN d.o_orderkey IS NOT NULL THEN d.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN d.o_orderkey IS NOT NULL THEN d.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN d.o_orderkey IS NOT NULL THEN d.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
FROM t LEFT JOIN d ON t.o_orderkey = d.o_orderkey
""",
)
def q_merge_update_matched(spark, sf_dir):
    return merge_update_matched(_orders_target(spark, sf_dir), _orders_day(spark, sf_dir), "o_orderkey")


@register(
    "merge_insert_unmatched",
    _MERGE_CTE + "SELECT d.* FROM d WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = d.o_orderkey)",
)
def q_merge_insert_unmatched(spark, sf_dir):
    return merge_insert_unmatched(_orders_target(spark, sf_dir), _orders_day(spark, sf_dir), "o_orderkey")


# Null keys on both sides: pending orders lose their key in the target, low
# priority orders lose it in the day. Null never matches: the former stay
# as they are, the latter are inserted.
@register(
    "merge_null_keys",
    f"""
WITH t AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS o_orderkey,
                  o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
           FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01 00:00:00'),
d AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS o_orderkey,
             o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus,
             o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-15 00:00:00')
"""
    + _MERGE_BODY,
)
def q_merge_null_keys(spark, sf_dir):
    t = _orders_target(spark, sf_dir).withColumn(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderkey"))
    )
    d = _orders_day(spark, sf_dir).withColumn(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderkey"))
    )
    return merge_upsert(t, d, "o_orderkey")


# --------------------------------------------------------------------------
# Shapes: conform, union, flatten, explode
# --------------------------------------------------------------------------


@register(
    "conform_columns",
    """
SELECT c_name, c_custkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS c_phone FROM customer
""",
)
def q_conform_columns(spark, sf_dir):
    # reorder, drop c_nationkey, add an absent c_phone as a typed null
    target = T.StructType(
        [
            T.StructField("c_name", T.StringType()),
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_mktsegment", T.StringType()),
            T.StructField("c_phone", T.StringType()),
        ]
    )
    return conform_columns(table(spark, sf_dir, "customer"), target)


@register(
    "union_pages",
    """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment FROM customer
UNION ALL
SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       CAST(NULL AS VARCHAR) AS mktsegment FROM supplier
""",
)
def q_union_pages(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"),
    )
    supp = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"),
    )
    return union_pages([cust, supp])


_EVENTS_FLAT_SQL = """
SELECT event_id, ts, event_type AS "actor.type", user_id AS "actor.user.id", value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS "props.k", CAST(NULL AS VARCHAR) AS "props.note"
FROM events
"""


@register("record_flatten", _EVENTS_FLAT_SQL)
def q_record_flatten(spark, sf_dir):
    # nested records: actor{type, user{id}}, props parsed from its JSON text;
    # props.note is a key no record carries (conformed to null)
    ev = table(spark, sf_dir, "events")
    nested = ev.select(
        "event_id",
        "ts",
        F.struct(F.col("event_type").alias("type"), F.struct(F.col("user_id").alias("id")).alias("user")).alias("actor"),
        "value",
        F.from_json("props", "k bigint, note string").alias("props"),
    )
    flat = record_flatten(nested)
    return conform_columns(
        flat, ["event_id", "ts", "actor.type", "actor.user.id", "value", "props.k", "props.note"]
    ).withColumn("props.note", F.col("`props.note`").cast("string"))


@register("record_explode", "SELECT conv_id, turn, role, text FROM conversations")
def q_record_explode(spark, sf_dir):
    # turns nested into pages of at most 64 turns per conversation (bounded
    # groups even for a very long conversation, or one whose turn numbers
    # repeat: a page is also cut into runs of 64 rows), then exploded again
    conv = table(spark, sf_dir, "conversations")
    pages = conv.groupBy("conv_id", F.floor(F.col("turn") / 64).alias("part"), row_run(64).alias("run")).agg(
        F.collect_list(F.struct("turn", "role", "text")).alias("turns")
    )
    return record_explode(pages, "turns", keep=["conv_id"])


# --------------------------------------------------------------------------
# Time windows and epoch rules on events
# --------------------------------------------------------------------------

EVENT_COLS = "event_id, ts, user_id, event_type, value, props"


@register(
    "daily_window",
    f"SELECT {EVENT_COLS} FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'",
)
def q_daily_window(spark, sf_dir):
    return daily_window(table(spark, sf_dir, "events"), "ts", "2024-01-15")


@register("since_start", f"SELECT {EVENT_COLS} FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'")
def q_since_start(spark, sf_dir):
    return since_start(table(spark, sf_dir, "events"), "ts", "2024-01-20")


@register(
    "to_epoch",
    """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s,
       CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS day_start_s
FROM events
""",
)
def q_to_epoch(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        to_epoch(F.col("ts")).alias("epoch_s"),
        to_epoch(day_start(F.date_format("ts", "yyyy-MM-dd"))).alias("day_start_s"),
    )


@register("from_epoch", "SELECT event_id, date_trunc('second', ts) AS ts_s FROM events")
def q_from_epoch(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", from_epoch(to_epoch(F.col("ts"))).alias("ts_s"))


@register(
    "day_bounds",
    """
SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS ds,
       CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS start_unix,
       CAST(epoch(date_trunc('day', ts)) AS BIGINT) + 86399 AS end_unix
FROM events
""",
)
def q_day_bounds(spark, sf_dir):
    # the request bounds of each day that has events: first and last whole second
    days = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("ds")).distinct()
    return days.select(
        "ds",
        to_int(to_epoch(day_start(F.col("ds")))).alias("start_unix"),
        (to_int(to_epoch(end_of_day(F.col("ds")))) - 1).alias("end_unix"),
    )


@register(
    "link_param",
    """
SELECT page_id,
       regexp_extract(url, '^[A-Za-z]+://([^/?#]+)', 1) AS host,
       replace(url, regexp_extract(url, '^[A-Za-z]+://[^/?#]+', 0), '') AS path,
       NULLIF(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page_param
FROM pages
""",
)
def q_link_param(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    host = F.try_parse_url("url", F.lit("HOST"))
    prefix = F.concat(F.try_parse_url("url", F.lit("PROTOCOL")), F.lit("://"), host)
    return pages.select(
        "page_id",
        host.alias("host"),
        strip_prefix(F.col("url"), prefix).alias("path"),
        link_param(F.col("url"), "page").alias("page_param"),
    )


@register(
    "length_rule",
    """
SELECT 'text' AS column_name, CAST(20000 AS BIGINT) AS max_len,
       CAST(count(*) FILTER (WHERE length(text) > 20000) AS BIGINT) AS n_over,
       CAST(max(length(text)) AS BIGINT) AS longest FROM documents
UNION ALL
SELECT 'lang', CAST(2 AS BIGINT), CAST(count(*) FILTER (WHERE length(lang) > 2) AS BIGINT),
       CAST(max(length(lang)) AS BIGINT) FROM documents
UNION ALL
SELECT 'source', CAST(64 AS BIGINT), CAST(count(*) FILTER (WHERE length(source) > 64) AS BIGINT),
       CAST(max(length(source)) AS BIGINT) FROM documents
""",
)
def q_length_rule(spark, sf_dir):
    return length_violations(table(spark, sf_dir, "documents"), {"text": 20000, "lang": 2, "source": 64})


# --------------------------------------------------------------------------
# Specs of the driver tables loaded as objects. events is nested on the wire
# (actor.type, actor.user.id) to carry dotted names through every step.
# --------------------------------------------------------------------------

EVENTS = ObjectSpec(
    "events",
    parse_columns(
        """
event_id bigint
ts ntz
actor.type string 64
actor.user.id bigint
value double
props json 256
"""
    ),
    key="event_id",
    time_column="ts",
)

EVENTS_FLAT = ObjectSpec(
    "events",
    parse_columns(
        """
event_id bigint
ts ntz
user_id bigint
event_type string
value double
props string
"""
    ),
    key="event_id",
    time_column="ts",
)

CUSTOMER = ObjectSpec(
    "customer",
    parse_columns(
        """
c_custkey bigint
c_name string 64
c_nationkey int
c_acctbal double
c_mktsegment string 32
"""
    ),
    key="c_custkey",
    time_column=None,
)

SUPPLIER = ObjectSpec(
    "supplier",
    parse_columns(
        """
s_suppkey bigint
s_name string 64
s_nationkey int
s_acctbal double
"""
    ),
    key="s_suppkey",
    time_column=None,
)

PART = ObjectSpec(
    "part",
    parse_columns(
        """
p_partkey bigint
p_name string 128
p_brand string 32
p_type string 64
p_size int
p_retailprice double
"""
    ),
    key="p_partkey",
    time_column=None,
)

DOCUMENTS = ObjectSpec(
    "documents",
    parse_columns(
        """
doc_id bigint
text string
lang string 8
source string 64
n_chars bigint
"""
    ),
    key="doc_id",
    time_column=None,
)

ORDERS = ObjectSpec(
    "orders",
    parse_columns(
        """
o_orderkey bigint
o_custkey bigint
o_orderstatus string 1
o_totalprice double
o_orderdate ntz
o_orderpriority string 15
"""
    ),
    key="o_orderkey",
    time_column="o_orderdate",
)

ORDER_LISTS = ObjectSpec(
    "orders",
    parse_columns(
        """
o_orderkey bigint
ids array<bigint>
tags array<string>
"""
    ),
    key="o_orderkey",
    time_column=None,
)

ORDER_NOTES = ObjectSpec("orders", (*ORDER_LISTS.columns, *parse_columns("notes json 200")), key="o_orderkey", time_column=None)

PAGE_SIZE = 1000


def _events_nested_sql_cols() -> str:
    return 'event_id, ts, event_type AS "actor.type", user_id AS "actor.user.id", value, props'


def events_flat(spark, sf_dir) -> DataFrame:
    """events with the wire's dotted names."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        "ts",
        F.col("event_type").alias("actor.type"),
        F.col("user_id").alias("actor.user.id"),
        "value",
        "props",
    )


def _land(records: DataFrame, spec: ObjectSpec, out_dir: str, stop_page: int | None = None, **how) -> str:
    """Land flat records as page documents of at most PAGE_SIZE ids each."""
    wire = nest(to_wire_text_times(records))
    return land_pages(
        wire, spec.name, out_dir, F.floor(c(spec.key) / PAGE_SIZE), link_field=spec.link_field,
        stop_page=stop_page, request_field=spec.request_field, **how,
    )


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


# --------------------------------------------------------------------------
# Pages
# --------------------------------------------------------------------------


@register("page_source", f"SELECT {_events_nested_sql_cols()} FROM events")
def q_page_source(spark, sf_dir):
    root = _land(events_flat(spark, sf_dir), EVENTS, scratch_dir(spark, "pages"))
    recs = wire_records(page_source(spark, EVENTS, root), EVENTS)
    return recs.select(*table_columns_from_wire(EVENTS))


@register(
    "page_stop",
    f"""
SELECT {_events_nested_sql_cols()} FROM events
WHERE floor(event_id / {PAGE_SIZE}) <= least(6, (SELECT max(floor(event_id / {PAGE_SIZE})) FROM events))
""",
)
def q_page_stop(spark, sf_dir):
    # page 6 was flagged end_of_stream; later pages belong to a stale fetch
    root = _land(events_flat(spark, sf_dir), EVENTS, scratch_dir(spark, "pages"), stop_page=6, headers=True, blocks=True)
    recs = wire_records(landed_pages(spark, EVENTS, root), EVENTS)
    return recs.select(*table_columns_from_wire(EVENTS))


# Contract of the next query: props is not in it, so its key k is dropped;
# note is in it, and no event carries one.
EVENTS_NOTED = ObjectSpec("events", parse_columns("event_id bigint\nts ntz\nactor.type string 32\nactor.user.id bigint\nvalue double\nnote string 64"), key="event_id", time_column="ts")


@register(
    "wire_report",
    """
SELECT unnest(['event_id', 'ts', 'actor.type', 'actor.user.id', 'value', 'props.k', 'note']) AS column_name,
       unnest(['kept', 'kept', 'kept', 'kept', 'kept', 'extra', 'absent']) AS finding,
       unnest(['bigint', 'string', 'string', 'bigint', 'number', 'bigint', NULL]) AS wire_type,
       unnest([count(event_id), count(ts), count(event_type), count(user_id), count(value), count(json_extract(props, '$.k')), 0]) AS n_records
FROM events
""",
)
def q_wire_report(spark, sf_dir):
    # what landed pages carry against the columns a load would keep
    flat = events_flat(spark, sf_dir).withColumn("props", F.from_json("props", "k bigint"))
    root = _land(flat.select("*", F.col("props.k").alias("props.k")).drop("props"), EVENTS, scratch_dir(spark, "pages"))
    return wire_report(spark, EVENTS_NOTED, root)


@register(
    "page_order",
    f"""
SELECT event_id, event_id // {PAGE_SIZE} - (SELECT min(event_id // {PAGE_SIZE}) FROM events) AS page, event_type
FROM events
""",
)
def q_page_order(spark, sf_dir):
    # the same pages without numbers: each carries the cursor it answers and
    # the next one; their order comes from following the cursors
    linked = EVENTS.with_links()
    root = _land(events_flat(spark, sf_dir), linked, scratch_dir(spark, "pages"))
    pages = page_source(spark, linked, root)
    return record_explode(pages, EVENTS.name, keep=["page"]).select(
        F.col("event_id").cast("bigint").alias("event_id"), "page", F.col("actor.type").alias("event_type")
    )


# --------------------------------------------------------------------------
# CSV stage and typed load
# --------------------------------------------------------------------------


@register("csv_stage", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_stage(spark, sf_dir):
    # whole documents (newlines, quotes, commas) through the CSV stage and back
    docs = conform_columns(table(spark, sf_dir, "documents"), DOCUMENTS.table_schema())
    return stage_and_load(spark, docs, DOCUMENTS, scratch_dir(spark, "stage"))


@register("typed_load", f"SELECT {ORDERS_COLS} FROM orders")
def q_typed_load(spark, sf_dir):
    # text as a pandas extract writes it: nullable ids as 123.0, ISO time with Z
    o = table(spark, sf_dir, "orders")
    text = o.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("o_orderkey"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("o_orderdate"),
        "o_orderpriority",
    )
    path = csv_stage_write(text, scratch_dir(spark, "stage"))
    return typed_load(csv_stage_scan(spark, path, ORDERS.text_schema()), ORDERS)


@register(
    "array_text",
    """
SELECT o_orderkey, to_json([o_orderkey, o_custkey])::VARCHAR AS ids_json,
       to_json([o_orderstatus, o_orderpriority])::VARCHAR AS tags_json,
       CAST(2 AS INTEGER) AS n_ids, o_orderpriority AS priority
FROM orders
""",
)
def q_array_text(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    lists = o.select(
        "o_orderkey",
        F.array("o_orderkey", "o_custkey").alias("ids"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
    )
    typed = stage_and_load(spark, lists, ORDER_LISTS, scratch_dir(spark, "stage"))
    return typed.select(
        "o_orderkey",
        F.to_json("ids").alias("ids_json"),
        F.to_json("tags").alias("tags_json"),
        F.size("ids").alias("n_ids"),
        F.element_at("tags", 2).alias("priority"),
    )


@register(
    "array_text_python",
    """
SELECT o_orderkey, to_json([o_orderkey, NULL, o_custkey])::VARCHAR AS ids_json,
       to_json([o_orderstatus || '''s', NULL, '"' || o_orderpriority || '"', 'A' || chr(10) || chr(92) || 'é'])::VARCHAR AS tags_json,
       CAST(4 AS INTEGER) AS n_tags, o_orderpriority || '''' AS note
FROM orders
""",
)
def q_array_text_python(spark, sf_dir):
    # the same lists as pandas writes them: nullable ids as 123.0, None, either
    # quote, escapes; a list of objects whose note holds an apostrophe
    o = table(spark, sf_dir, "orders")
    tags = r"""["%s's", None, '"%s"', '\x41\n\\\xe9']"""
    text = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.format_string("[%s.0, None, %s.0]", "o_orderkey", "o_custkey").alias("ids"),
        F.format_string(tags, "o_orderstatus", "o_orderpriority").alias("tags"),
        F.format_string("""[{'note': "%s'", 'by': None}]""", "o_orderpriority").alias("notes"),
    )
    path = csv_stage_write(text, scratch_dir(spark, "stage"))
    typed = typed_load(csv_stage_scan(spark, path, ORDER_NOTES.text_schema()), ORDER_NOTES)
    return typed.select(
        "o_orderkey",
        F.to_json("ids").alias("ids_json"),
        F.to_json("tags").alias("tags_json"),
        F.size("tags").alias("n_tags"),
        F.get_json_object("notes", "$[0].note").alias("note"),
    )


@register(
    "dated_stage_path",
    f"SELECT {EVENT_COLS} FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'",
)
def q_dated_stage_path(spark, sf_dir):
    # stage every day of events under ds=..., read back one day by partition filter
    ev = table(spark, sf_dir, "events")
    root = scratch_dir(spark, "stage")
    text = ev.select(*text_columns(EVENTS_FLAT), F.date_format("ts", "yyyy-MM-dd").alias("ds"))
    csv_stage_write(text, root, partition_by=["ds"])
    schema = EVENTS_FLAT.text_schema().add("ds", T.StringType())
    day = csv_stage_scan(spark, root, schema, partition_by=["ds"]).where(F.col("ds") == "2024-01-15")
    return typed_load(day, EVENTS_FLAT)


# --------------------------------------------------------------------------
# Tables and pipelines
# --------------------------------------------------------------------------

CUSTOMER_COLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


def _paths(spark) -> LoadPaths:
    root = scratch_dir(spark, "run")
    return LoadPaths(landing=f"{root}/landing", stage=f"{root}/stage", tables=f"{root}/tables")


@register("full_refresh", f"SELECT {CUSTOMER_COLS} FROM customer")
def q_full_refresh(spark, sf_dir):
    # an older extract is the current table; the new extract replaces it
    paths, name = _paths(spark), _table_name("customer")
    cust = table(spark, sf_dir, "customer")
    older = cust.withColumn("c_acctbal", F.col("c_acctbal") - 1)
    publish(spark, older, name, paths.table_root(name))
    fresh = stage_and_load(spark, cust, CUSTOMER, stage_path(paths.stage, "customer"))
    publish(spark, fresh, name, paths.table_root(name))
    return spark.table(name)


@register("table_like", f"SELECT {CUSTOMER_COLS} FROM customer")
def q_table_like(spark, sf_dir):
    # the day table takes the target's schema; staged rows load into it
    paths, name = _paths(spark), _table_name("customer")
    cust = table(spark, sf_dir, "customer")
    table_recreate(spark, name, CUSTOMER.table_schema(), paths.table_root(name))
    schema = table_like(spark, name)
    typed = stage_and_load(spark, cust, CUSTOMER, stage_path(paths.stage, "customer", "2024-01-16"))
    return load_like(typed, schema)


_INCR_DAY = "2024-01-16"


def _other_days(flat: DataFrame, first: str = _INCR_DAY) -> DataFrame:
    """All events but those from day ``first`` to the loaded day."""
    return flat.where((F.col("ts") < day_start(first)) | (F.col("ts") >= end_of_day(_INCR_DAY)))


@register("full_load", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def q_full_load(spark, sf_dir):
    paths, name = _paths(spark), _table_name("part")
    _land(table(spark, sf_dir, "part"), PART, paths.landing_full("part", _INCR_DAY), headers=True)
    full_load(spark, PART, _INCR_DAY, paths, name)
    return spark.table(name)




@register(
    "incremental_load",
    f"""
SELECT {_events_nested_sql_cols()} FROM events
WHERE ts < TIMESTAMP '2024-01-15 00:00:00' OR ts >= TIMESTAMP '2024-01-17 00:00:00'
UNION ALL
SELECT event_id, ts + INTERVAL 1 DAY AS ts, event_type AS "actor.type", user_id AS "actor.user.id",
       value + 1 AS value, props
FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'
UNION ALL
SELECT {_events_nested_sql_cols()} FROM events
WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00'
""",
)
def q_incremental_load(spark, sf_dir):
    # full extract of every other day; then the day's pages: the events of
    # 2024-01-16 plus the previous day's events re-sent on the day with
    # value + 1 (same ids -> updated in place)
    paths, name = _paths(spark), _table_name("events")
    flat = events_flat(spark, sf_dir)
    _land(_other_days(flat), EVENTS, paths.landing_full("events", _INCR_DAY))
    full_load(spark, EVENTS, _INCR_DAY, paths, name)
    new = daily_window(flat, "ts", _INCR_DAY)
    resent = daily_window(flat, "ts", "2024-01-15").select(
        "event_id",
        F.timestamp_add("DAY", F.lit(1), F.col("ts")).alias("ts"),
        "`actor.type`",
        "`actor.user.id`",
        (F.col("value") + 1).alias("value"),
        "props",
    )
    _land(new.unionByName(resent), EVENTS, paths.landing_day("events", _INCR_DAY))
    res = incremental_load(spark, EVENTS, _INCR_DAY, paths, name)
    assert res.branch == "daily"
    return spark.table(name)


@register("load_with_fallback", f"SELECT {CUSTOMER_COLS}, 'full' AS branch FROM customer")
def q_load_with_fallback(spark, sf_dir):
    # first run: no target table, so the daily merge fails and the full load builds it
    paths, name = _paths(spark), _table_name("customer")
    _land(table(spark, sf_dir, "customer"), CUSTOMER, paths.landing_full("customer", _INCR_DAY))
    res = load_with_fallback(spark, CUSTOMER, _INCR_DAY, paths, name)
    return spark.table(name).withColumn("branch", F.lit(res.branch))


@register(
    "load_all_objects",
    """
SELECT 'customer' AS object, 'full' AS branch, c_custkey AS id, c_name AS name, c_acctbal AS amount FROM customer
UNION ALL SELECT 'part', 'full', p_partkey, p_name, p_retailprice FROM part
UNION ALL SELECT 'events', 'daily', event_id, event_type,
  CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00' THEN value + 1 ELSE value END
FROM events
""",
)
def q_load_all_objects(spark, sf_dir):
    # customer and part have no table yet and load in full; events holds all
    # days, and the day's pages (value + 1) are merged into it
    paths = _paths(spark)
    specs = [CUSTOMER, PART, EVENTS]
    names = {spec.name: _table_name(spec.name) for spec in specs}
    flat = events_flat(spark, sf_dir)
    frames = {"customer": table(spark, sf_dir, "customer"), "part": table(spark, sf_dir, "part"), "events": flat}
    for spec in specs:
        _land(frames[spec.name], spec, paths.landing_full(spec.name, _INCR_DAY))
    full_load(spark, EVENTS, _INCR_DAY, paths, names["events"])
    day = daily_window(flat, "ts", _INCR_DAY).withColumn("value", F.col("value") + 1)
    _land(day, EVENTS, paths.landing_day("events", _INCR_DAY))
    results = load_all_objects(spark, specs, _INCR_DAY, paths, table_of=lambda s: names[s.name])
    failed = {k: r.error for k, r in results.items() if r.branch == "failed"}
    if failed:
        raise RuntimeError(f"loads failed: {failed}")
    shown = {"customer": ("c_custkey", "c_name", "c_acctbal"), "part": ("p_partkey", "p_name", "p_retailprice"),
             "events": ("event_id", "actor.type", "value")}
    return union_pages([
        spark.table(names[o]).select(
            F.lit(o).alias("object"), F.lit(results[o].branch).alias("branch"),
            *[c(n).alias(a) for n, a in zip(cols, ("id", "name", "amount"))],
        )
        for o, cols in shown.items()
    ])


def _sql_rows(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)


@register(
    "script_load",
    f"""
SELECT * FROM (VALUES {_sql_rows([*DEMO_LITERAL_ROWS, (*DEMO_PARAMS.values(), _INCR_DAY)])}) AS t({", ".join(DEMO_COLUMNS)})
UNION ALL
SELECT c_name AS col_1, 'parameter-value-1' AS col_2, '{_INCR_DAY}' AS col_3 FROM customer
""",
)
def q_script_load(spark, sf_dir):
    # the demo script, plus one bound INSERT ... SELECT over customer so the
    # statement list reads a driver table (values bound, never spliced)
    root = scratch_dir(spark, "tables")
    name = _table_name("demo")
    extra = [("SELECT c_name AS col_1, :value_1 AS col_2, :ds AS col_3 FROM {customer}",
              {"value_1": DEMO_PARAMS["value_1"], "ds": _INCR_DAY})]
    return script_load(spark, _INCR_DAY, name, root, extra=extra,
                       sources={"customer": table(spark, sf_dir, "customer")})


@register("script_text", ORACLE["script_load"])
def q_script_text(spark, sf_dir):
    # the demo script from its text, with one more statement that reads customer
    root, name = scratch_dir(spark, "tables"), _table_name("demo")
    more = "INSERT INTO IDENTIFIER(:target) (col_1, col_2, col_3) SELECT c_name, :value_1, day FROM IDENTIFIER(:customer);\nEND"
    text = more.join(DEMO_SCRIPT.rsplit("END", 1))
    return script_text_load(spark, text, _INCR_DAY, name, root, sources={"customer": table(spark, sf_dir, "customer")})


@register("incremental_stream", ORACLE["incremental_load"])
def q_incremental_stream(spark, sf_dir):
    # three fetches land one after the other in a watched folder: every other
    # day, then the 15th, then the 16th with the 15th re-sent (value + 1).
    # The stream folds them in landing order; each is a folder of files.
    paths, name = _paths(spark), _table_name("events")
    watched = f"{paths.landing}/events/stream"
    flat = events_flat(spark, sf_dir)
    fetches = [
        _other_days(flat, "2024-01-15"),
        daily_window(flat, "ts", "2024-01-15"),
        daily_window(flat, "ts", _INCR_DAY).unionByName(
            daily_window(flat, "ts", "2024-01-15").select(
                "event_id",
                F.timestamp_add("DAY", F.lit(1), F.col("ts")).alias("ts"),
                "`actor.type`",
                "`actor.user.id`",
                (F.col("value") + 1).alias("value"),
                "props",
            )
        ),
    ]
    for i, recs in enumerate(fetches):
        # each writer task lands its own file of the fetch's folder
        wire = nest(to_wire_text_times(recs))
        land_pages(wire, EVENTS.name, f"{watched}/fetch={i:06d}", F.floor(c(EVENTS.key) / PAGE_SIZE))
    return drain(spark, stream_load(spark, EVENTS, watched, paths, name), name)


# --------------------------------------------------------------------------
# Partition-granular merges: the target is stored partitioned by a value
# derived from a stable column; a day rewrites only the partitions it touches.
# --------------------------------------------------------------------------


@register("merge_partitioned", _MERGE_CTE + _MERGE_BODY)
def q_merge_partitioned(spark, sf_dir):
    # orders stored by order month; the day touches June and July 2001 only
    root, name = scratch_dir(spark, "tables"), _table_name("orders")
    month = partition_value(F.col("o_orderdate"), "yyyy-MM")
    publish_partitioned(spark, _orders_target(spark, sf_dir).withColumn("o_month", month), name, root, "o_month")
    day = _orders_day(spark, sf_dir).withColumn("o_month", month)
    assert_unique_keys(day, "o_orderkey")
    upsert_partitions(spark, name, day, "o_orderkey", "o_month", root)
    return spark.table(name).drop("o_month")


@register("incremental_load_partitioned", ORACLE["incremental_load"])
def q_incremental_load_partitioned(spark, sf_dir):
    # the events table stored by day of ts: the re-sent records of the 15th
    # move to the 16th, so the 15th is rewritten without them
    spec = EVENTS.with_partition("ds", "ts", "yyyy-MM-dd")
    paths, name = _paths(spark), _table_name("events")
    flat = events_flat(spark, sf_dir)
    _land(_other_days(flat), spec, paths.landing_full("events", _INCR_DAY))
    full_load(spark, spec, _INCR_DAY, paths, name)
    resent = daily_window(flat, "ts", "2024-01-15").select(
        "event_id",
        F.timestamp_add("DAY", F.lit(1), F.col("ts")).alias("ts"),
        "`actor.type`",
        "`actor.user.id`",
        (F.col("value") + 1).alias("value"),
        "props",
    )
    _land(daily_window(flat, "ts", _INCR_DAY).unionByName(resent), spec, paths.landing_day("events", _INCR_DAY))
    res = incremental_load(spark, spec, _INCR_DAY, paths, name)
    assert res.branch == "daily"
    return spark.table(name).drop("ds")


@register(
    "daily_source",
    f"""
SELECT {_events_nested_sql_cols()} FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'
""",
)
def q_daily_source(spark, sf_dir):
    # every landed page is read; the day's records are kept by their clock
    root = _land(events_flat(spark, sf_dir), EVENTS, scratch_dir(spark, "pages"))
    return daily_source(spark, EVENTS, root, "2024-01-15", by_clock=True).select(*table_columns_from_wire(EVENTS))


@register(
    "daily_source_response",
    """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS ts, event_type AS "actor.type",
       user_id AS "actor.user.id", value, props
FROM events
""",
)
def q_daily_source_response(spark, sf_dir):
    # the day's own landing: every record is the day's, with a clock outside the day or none
    flat = events_flat(spark, sf_dir).withColumn("ts", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
    root = _land(flat, EVENTS, scratch_dir(spark, "pages"))
    return daily_source(spark, EVENTS, root, "2024-01-15").select(*table_columns_from_wire(EVENTS))


@register("csv_stage_exact", "SELECT doc_id, '  ' || text || chr(9) || ' ' || chr(10) AS text, lang, source, n_chars FROM documents")
def q_csv_stage_exact(spark, sf_dir):
    # blank space and a line break at the ends of a text come back as they were
    docs = conform_columns(table(spark, sf_dir, "documents"), DOCUMENTS.table_schema())
    docs = docs.withColumn("text", F.concat(F.lit("  "), "text", F.lit("\t \n")))
    return stage_and_load(spark, docs, DOCUMENTS, scratch_dir(spark, "stage"))


@register("object_guard", "SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS organization_id FROM customer")
def q_object_guard(spark, sf_dir):
    # customers as users, loaded by object name; a name that is not known is refused
    try:
        object_spec("invoices")
    except ValueError:
        spec = object_spec("users")
    paths, name = _paths(spark), _table_name("users")
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("organization_id"))
    _land(users, spec, paths.landing_full(spec.name, _INCR_DAY))
    full_load(spark, spec, _INCR_DAY, paths, name)
    return spark.table(name).select("id", "name", "organization_id")


@register("merge_bucketed", _MERGE_CTE + _MERGE_BODY)
def q_merge_bucketed(spark, sf_dir):
    # orders stored in 16 hash buckets of the key: a day too big to broadcast
    # is shuffled into the target's buckets, the target itself is not
    root, name = scratch_dir(spark, "tables"), _table_name("orders")
    publish_bucketed(spark, _orders_target(spark, sf_dir), name, root, "o_orderkey", 16)
    merged = merge_upsert(spark.table(name), _orders_day(spark, sf_dir), "o_orderkey")
    publish_bucketed(spark, merged, name, root, "o_orderkey", 16, cluster=False)
    return spark.table(name)


# --------------------------------------------------------------------------
# One query per remaining inventory item that the composed queries above
# only use in passing.
# --------------------------------------------------------------------------

_NULL_KEY_CTE = """
WITH t AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS o_orderkey,
                  o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
           FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01 00:00:00'),
d AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS o_orderkey,
             o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus,
             o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-15 00:00:00')
"""


@register(
    "merge_match",
    _NULL_KEY_CTE
    + """
SELECT t.o_orderkey AS o_orderkey, t.o_orderstatus AS old_status, d.o_orderstatus AS new_status,
       t.o_totalprice AS old_totalprice, d.o_totalprice AS new_totalprice
FROM t JOIN d ON t.o_orderkey = d.o_orderkey
""",
)
def q_merge_match(spark, sf_dir):
    # the pairs the merge updates, with null keys on both sides (never paired)
    t = _orders_target(spark, sf_dir).withColumn(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderkey"))
    )
    d = _orders_day(spark, sf_dir).withColumn(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderkey"))
    )
    return merge_match(t, d, "o_orderkey").select(
        F.col("target.o_orderkey").alias("o_orderkey"),
        F.col("target.o_orderstatus").alias("old_status"),
        F.col("day.o_orderstatus").alias("new_status"),
        F.col("target.o_totalprice").alias("old_totalprice"),
        F.col("day.o_totalprice").alias("new_totalprice"),
    )


@register(
    "int_text",
    f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS o_custkey,
       o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders
""",
)
def q_int_text(spark, sf_dir):
    # a nullable integer column as a pandas extract stages it: floats, so
    # 123.0, and an empty field for null; the key has no nulls and stays 123
    o = table(spark, sf_dir, "orders")
    cust = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_custkey"))
    text = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.concat(cust.cast("string"), F.lit(".0")).alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        "o_orderpriority",
    )
    path = csv_stage_write(text, scratch_dir(spark, "stage"))
    return typed_load(csv_stage_scan(spark, path, ORDERS.text_schema()), ORDERS)


_BIND_NOTE = "it's bound; DROP TABLE orders --"


@register(
    "bind_params",
    """
SELECT o_orderkey, o_totalprice, 'it''s bound; DROP TABLE orders --' AS note, '2000-01-01' AS ds
FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'
""",
)
def q_bind_params(spark, sf_dir):
    # values reach the statement as bound parameters: the quote and the
    # statement text inside the note stay data
    return bound_rows(
        spark,
        "SELECT o_orderkey, o_totalprice, :note AS note, :ds AS ds FROM {orders} "
        "WHERE o_orderpriority = :priority AND o_orderdate >= CAST(:ds AS TIMESTAMP_NTZ)",
        {"note": _BIND_NOTE, "priority": "1-URGENT", "ds": "2000-01-01"},
        orders=table(spark, sf_dir, "orders"),
    )


@register(
    "insert_rows",
    """
SELECT c_mktsegment AS col_1, CAST(c_custkey AS VARCHAR) AS col_2, c_name AS col_3 FROM customer
UNION ALL
SELECT CAST(s_nationkey AS VARCHAR) AS col_1, CAST(s_suppkey AS VARCHAR) AS col_2, s_name AS col_3 FROM supplier
""",
)
def q_insert_rows(spark, sf_dir):
    # an empty three-column table, then two inserts whose column lists are in
    # another order than the table's; the rows are published with one write
    root, name = scratch_dir(spark, "tables"), _table_name("demo")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in DEMO_COLUMNS])
    table_recreate(spark, name, schema, root)
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("col_3"), F.col("c_mktsegment").alias("col_1"),
        F.col("c_custkey").cast("string").alias("col_2"),
    )
    supp = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("col_2"), F.col("s_name").alias("col_3"),
        F.col("s_nationkey").cast("string").alias("col_1"),
    )
    publish(spark, insert_rows([spark.table(name), cust, supp], DEMO_COLUMNS), name, root)
    return spark.table(name)


@register("table_recreate", f"SELECT {CUSTOMER_COLS} FROM customer")
def q_table_recreate(spark, sf_dir):
    # the table was left in an older shape (two columns); it is dropped and
    # created with the declared schema, then the extract is inserted
    paths, name = _paths(spark), _table_name("customer")
    root = paths.table_root(name)
    cust = table(spark, sf_dir, "customer")
    publish(spark, cust.select("c_custkey", "c_name"), name, root)
    table_recreate(spark, name, CUSTOMER.table_schema(), root)
    rows = conform_columns(cust, CUSTOMER.table_schema())
    publish(spark, insert_rows([spark.table(name), rows], CUSTOMER.names), name, root)
    return spark.table(name)


@register(
    "quoted_columns",
    """
SELECT event_id, event_type AS "actor.type", user_id AS "actor.user.id", value
FROM events WHERE event_type IN ('click', 'purchase') AND user_id IS NOT NULL
""",
)
def q_quoted_columns(spark, sf_dir):
    # a stored table with dotted column names, filtered and projected by them;
    # both filters reach the Parquet scan
    root, name = scratch_dir(spark, "tables"), _table_name("events")
    publish(spark, events_flat(spark, sf_dir), name, root)
    ev = spark.table(name)
    return ev.where(c("actor.type").isin("click", "purchase") & c("actor.user.id").isNotNull()).select(
        "event_id", c("actor.type"), c("actor.user.id"), "value"
    )


_LINK_HOST = "https://example.invalid"


@register(
    "strip_prefix",
    f"""
SELECT DISTINCT event_id // {PAGE_SIZE} AS page,
       CASE WHEN event_id // {PAGE_SIZE} = (SELECT max(event_id // {PAGE_SIZE}) FROM events) THEN NULL
            ELSE '/api/v2/incremental?start_time=' || CAST(event_id // {PAGE_SIZE} + 1 AS VARCHAR) END AS next_path,
       CASE WHEN event_id // {PAGE_SIZE} = (SELECT max(event_id // {PAGE_SIZE}) FROM events) THEN NULL
            ELSE event_id // {PAGE_SIZE} + 1 END AS start_time
FROM events
""",
)
def q_strip_prefix(spark, sf_dir):
    # next links of landed pages, host removed (the request path), and the
    # start time the link carries; the last page has no link
    root = _land(events_flat(spark, sf_dir), EVENTS, scratch_dir(spark, "pages"))
    pages = page_source(spark, EVENTS, root)
    return pages.select(
        "page",
        strip_prefix(F.col("next_page"), _LINK_HOST).alias("next_path"),
        link_param(F.col("next_page"), "start_time").cast("bigint").alias("start_time"),
    ).distinct()


@register(
    "envelope_guard",
    f"""
SELECT event_id // {PAGE_SIZE} AS page, count(*) AS n_records,
       event_id // {PAGE_SIZE} = (SELECT max(event_id // {PAGE_SIZE}) FROM events) AS end_of_stream
FROM events GROUP BY event_id // {PAGE_SIZE}
""",
)
def q_envelope_guard(spark, sf_dir):
    # every landed document passes the guard (record array present, page
    # numbered); per page, the records its documents carry and its stop flag
    root = _land(events_flat(spark, sf_dir), EVENTS, scratch_dir(spark, "pages"))
    pages = page_source(spark, EVENTS, root)
    return pages.groupBy("page").agg(
        F.sum(F.size(EVENTS.name)).cast("bigint").alias("n_records"),
        F.max("end_of_stream").alias("end_of_stream"),
    )
