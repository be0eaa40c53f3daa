"""The page lander: bounded pages, stop flags, nesting that flatten undoes."""

from pyspark.sql import functions as F

from tableload.operators.flatten import record_flatten
from tableload.plans.pipelines import LoadPaths
from tableload.schemas import Col, ObjectSpec, parse_columns
from fixtures.landing import land_pages, nest, to_wire_text_times
from tableload.sources.pages import page_source, page_stop, wire_records
from tableload.sources.stage import csv_stage_scan, csv_stage_write, typed_load

SPEC = ObjectSpec(
    "items",
    parse_columns(
        """
id bigint
at ntz
a.b string
a.c.d bigint
"""
    ),
    time_column="at",
)


def flat_rows(spark, n):
    return spark.range(n).select(
        F.col("id"),
        F.timestamp_add("SECOND", F.col("id"), F.lit("2024-01-01 00:00:00.123456").cast("timestamp_ntz")).alias("at"),
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("a.b"),
        (F.col("id") * 2).alias("a.c.d"),
    )


def test_nest_then_flatten_is_identity(spark):
    flat = flat_rows(spark, 5)
    nested = nest(flat)
    assert nested.columns == ["id", "at", "a"]
    back = record_flatten(nested)
    assert back.columns == flat.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, flat.collect()))


def test_pages_bounded_and_flagged(spark, tmp_root):
    flat = flat_rows(spark, 2500)
    land_pages(nest(to_wire_text_times(flat)), "items", tmp_root, F.floor(F.col("id") / 1000), stop_page=1)
    pages = page_source(spark, SPEC, tmp_root)
    docs = pages.select("page", F.size("items").alias("n"), "end_of_stream", "next_page")
    assert docs.agg(F.max("n")).first()[0] <= 1000
    # a page may arrive as several documents; all carry the page's flag and link
    info = sorted(tuple(r) for r in docs.groupBy("page").agg(
        F.sum("n"), F.collect_set("end_of_stream"), F.collect_set("next_page")).collect())
    assert [(p, n, list(e)) for p, n, e, _ in info] == [(0, 1000, [False]), (1, 1000, [True]), (2, 500, [True])]
    assert [len(links) for *_, links in info] == [1, 0, 0] and info[0][3][0].endswith("start_time=1")
    recs = wire_records(page_stop(pages), SPEC)
    assert recs.count() == 2000
    r = recs.where("id = 7").collect()[0]
    assert r["at"] == "2024-01-01T00:00:07.123456" and r["a.c.d"] == "14"  # micros kept on the wire


def test_pandas_style_booleans_and_epochs(spark, tmp_root):
    text = spark.createDataFrame([("True", "1629305410.0"), ("False", None), (None, "0")], "flag string, seen string")
    spec = ObjectSpec("t", (Col("flag", "boolean"), Col("seen", "epoch")))
    csv_stage_write(text, tmp_root)
    got = [tuple(r) for r in typed_load(csv_stage_scan(spark, tmp_root, spec.text_schema()), spec).collect()]
    assert [g[0] for g in got] == [True, False, None]
    assert str(got[0][1]) == "2021-08-18 16:50:10" and got[1][1] is None and str(got[2][1]) == "1970-01-01 00:00:00"


def test_load_paths_layout():
    p = LoadPaths(landing="s3a://b/landing", stage="s3a://b/stage", tables="s3a://b/tables")
    assert p.landing_full("users", "2024-01-16") == "s3a://b/landing/users/full/ds=2024-01-16"
    assert p.landing_day("users", "2024-01-16") == "s3a://b/landing/users/ds=2024-01-16"
    assert p.table_root("users") == "s3a://b/tables/users"


def test_hot_key_page_is_split_into_bounded_documents(spark, tmp_root):
    # a third of the records share one id, so floor(id / 1000) puts them on one
    # page; it lands as several documents of at most 1,000 records each
    base = flat_rows(spark, 3000)
    hot = base.where("id < 1500").withColumn("id", F.lit(42).cast("bigint"))
    flat = base.unionByName(hot).repartition(3)
    land_pages(nest(to_wire_text_times(flat)), "items", tmp_root, F.floor(F.col("id") / 1000))
    pages = page_source(spark, SPEC, tmp_root)
    sizes = pages.select("page", F.size("items").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 1000
    per_page = {r["page"]: r["n"] for r in sizes.groupBy("page").agg(F.sum("n").alias("n")).collect()}
    assert per_page == {0: 2500, 1: 1000, 2: 1000}
    recs = wire_records(page_stop(pages), SPEC)
    assert recs.count() == 4500 and recs.where("id = 42").count() == 1501
