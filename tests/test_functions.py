"""Scalar rules: epoch, day bounds, links."""

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from tableload.functions.casts import (
    day_start,
    end_of_day,
    from_epoch,
    int_text,
    length_violations,
    link_param,
    strip_prefix,
    to_epoch,
    to_int,
)


def test_to_epoch_in_a_zone_matches_python(spark):
    when = dt.datetime(2024, 7, 4, 12, 30, 15, 999999)
    df = spark.createDataFrame([(when,)], "ts timestamp_ntz")
    got = df.select(to_epoch(F.col("ts"), "America/New_York").alias("ny"), to_epoch(F.col("ts")).alias("utc")).collect()[0]
    assert got["ny"] == int(when.replace(tzinfo=ZoneInfo("America/New_York")).timestamp())
    assert got["utc"] == int(when.replace(tzinfo=dt.timezone.utc).timestamp())


def test_to_epoch_ignores_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 1),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert df.select(to_epoch(F.col("ts"))).collect()[0][0] == 1704067201
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_day_bounds_and_from_epoch(spark):
    r = spark.range(1).select(
        to_int(to_epoch(day_start("2021-08-18"))).alias("start"),
        (to_int(to_epoch(end_of_day("2021-08-18"))) - 1).alias("end"),
        from_epoch(F.lit(1629305410)).alias("ts"),
    ).collect()[0]
    assert r["start"] == 1629244800 and r["end"] == 1629244800 + 86399
    assert r["ts"] == dt.datetime(2021, 8, 18, 16, 50, 10)


def test_links(spark):
    df = spark.createDataFrame(
        [("https://acme.example.com/api/v2/incremental/users.json?start_time=1629305410",),
         ("https://acme.example.com/api/v2/incremental/tickets/cursor.json?cursor=abc%3D",)],
        "url string",
    )
    got = df.select(
        strip_prefix(F.col("url"), "https://acme.example.com").alias("path"),
        link_param(F.col("url"), "start_time").alias("st"),
        link_param(F.col("url"), "cursor").alias("cur"),
    ).collect()
    assert got[0]["path"] == "/api/v2/incremental/users.json?start_time=1629305410"
    assert got[0]["st"] == "1629305410" and got[0]["cur"] is None
    assert got[1]["cur"] == "abc%3D"


def test_int_text(spark):
    df = spark.createDataFrame([("7",), ("7.0",), ("-3.00",), (None,)], "x string")
    assert [r[0] for r in df.select(int_text(F.col("x"))).collect()] == [7, 7, -3, None]


def test_length_violations(spark):
    df = spark.createDataFrame([("abc",), ("abcdef",), (None,)], "s string")
    r = length_violations(df, {"s": 4}).collect()[0]
    assert (r["column_name"], r["max_len"], r["n_over"], r["longest"]) == ("s", 4, 1, 6)


def test_literal_and_bound_rows(spark):
    from tableload.schemas import DEMO_COLUMNS, DEMO_LITERAL_ROWS
    from tableload.sources.literal import bound_rows, literal_source

    lit_rows = literal_source(spark, DEMO_LITERAL_ROWS, DEMO_COLUMNS)
    assert lit_rows.columns == list(DEMO_COLUMNS) and lit_rows.count() == 3
    got = bound_rows(spark, "SELECT :v AS col_1, :ds AS col_3", {"v": "it's; DROP TABLE x", "ds": "2024-01-16"})
    assert tuple(got.collect()[0]) == ("it's; DROP TABLE x", "2024-01-16")  # a quote is data, not SQL
