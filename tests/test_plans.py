"""Plan shapes that matter at scale, read from ``explain()`` output."""

import contextlib
import io
import re

import pytest

SF = "/root/testdata/sf0.01"


def plan_of(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def q(name):
    from tableload.queries import QUERIES

    return QUERIES[name]


def test_merge_broadcasts_day_and_never_shuffles_target(spark):
    plan = plan_of(q("merge_upsert")(spark, SF))
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan
    assert "BroadcastHashJoin LeftAnti BuildRight" in plan
    assert "SortMergeJoin" not in plan
    # the only exchange of rows is the distinct over matched day keys; the filter's words are aggregated in a subquery
    main = plan.split("===== Subqueries")[0]
    assert len(re.findall(r"^\(\d+\) Exchange\s*$", main, re.M)) == 1


def test_insert_half_reads_only_the_key(spark):
    plan = plan_of(q("merge_insert_unmatched")(spark, SF))
    # the key side reads the key (and the date its slice is filtered on), no payload
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_time_window_reaches_the_scan(spark):
    plan = plan_of(q("daily_window")(spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan and "LessThan(ts,2024-01-16T00:00)" in plan


def test_conform_prunes_columns(spark):
    plan = plan_of(q("conform_columns")(spark, SF))
    read = re.search(r"ReadSchema: (struct<[^\n]*>)", plan).group(1)
    assert "c_nationkey" not in read


def test_dated_stage_prunes_partitions(spark):
    plan = plan_of(q("dated_stage_path")(spark, SF))
    assert "PartitionFilters: [isnotnull(ds" in plan and "(ds#" in plan


def test_page_stop_subquery_reads_two_fields(spark):
    plan = plan_of(q("page_stop")(spark, SF))
    assert "ReadSchema: struct<page:bigint,end_of_stream:boolean>" in plan  # of the header set
    assert "PushedFilters: [IsNotNull(end_of_stream), EqualTo(end_of_stream,true)]" in plan


def test_dotted_name_filters_reach_the_scan(spark):
    plan = plan_of(q("quoted_columns")(spark, SF))
    assert "In(`actor.type`, [click,purchase])" in plan and "IsNotNull(`actor.user.id`)" in plan
    read = re.search(r"ReadSchema: (struct<[^\n]*>)", plan).group(1)
    assert "props" not in read and "ts" not in read


def test_merge_match_broadcasts_day(spark):
    plan = plan_of(q("merge_match")(spark, SF))
    assert "BroadcastHashJoin Inner BuildRight" in plan and "Exchange" not in plan.replace("BroadcastExchange", "")


@pytest.mark.parametrize("name", sorted(__import__("tableload.queries", fromlist=["QUERIES"]).QUERIES))
def test_no_python_udf_in_any_query(spark, name):
    plan = plan_of(q(name)(spark, "/root/testdata/sf0.001"), "extended")
    assert "EvalPython" not in plan and "PythonUDF" not in plan
