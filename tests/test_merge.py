"""merge_upsert: SQL MERGE semantics, checked against a plain Python model."""

import contextlib
import io
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tableload.operators import merge
from tableload.operators.merge import (
    duplicate_keys,
    hot_keys,
    key_filter,
    merge_insert_unmatched,
    merge_match,
    merge_update_matched,
    merge_upsert,
)

SCHEMA = "id bigint, a string, b double"


def model_merge(target, day):
    """MERGE INTO target USING day ON target.id = day.id (plain '=')."""
    by_id = {r[0]: r for r in day if r[0] is not None}
    out = [by_id.get(r[0], r) if r[0] is not None else r for r in target]
    t_ids = {r[0] for r in target if r[0] is not None}
    out += [r for r in day if r[0] is None or r[0] not in t_ids]
    return sorted(out, key=repr)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_null_overwrites_value(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], SCHEMA)
    d = spark.createDataFrame([(1, None, None)], SCHEMA)
    assert rows(merge_upsert(t, d, "id")) == [(1, None, None), (2, "y", 2.0)]


def test_duplicate_target_keys_each_updated(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (1, "x2", 1.5), (2, "y", 2.0)], SCHEMA)
    d = spark.createDataFrame([(1, "new", 9.0), (3, "z", 3.0)], SCHEMA)
    assert rows(merge_upsert(t, d, "id")) == sorted(
        [(1, "new", 9.0), (1, "new", 9.0), (2, "y", 2.0), (3, "z", 3.0)], key=repr
    )


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "t", 1.0), (1, "x", 1.0)], SCHEMA)
    d = spark.createDataFrame([(None, "d", 2.0), (None, "d2", 3.0), (1, "u", 4.0)], SCHEMA)
    got = rows(merge_upsert(t, d, "id"))
    assert got == sorted([(None, "t", 1.0), (1, "u", 4.0), (None, "d", 2.0), (None, "d2", 3.0)], key=repr)


def test_duplicate_day_keys_raise(spark):
    t = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    d = spark.createDataFrame([(5, "a", 1.0), (5, "b", 2.0), (None, "n", 0.0), (None, "m", 0.0)], SCHEMA)
    assert duplicate_keys(d, "id") == [5]
    with pytest.raises(ValueError, match="duplicate id"):
        merge_upsert(t, d, "id")


def test_halves_match_whole(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], SCHEMA)
    d = spark.createDataFrame([(2, "u", 5.0), (3, "z", 3.0)], SCHEMA)
    upd = rows(merge_update_matched(t, d, "id"))
    ins = rows(merge_insert_unmatched(t, d, "id"))
    assert upd == [(1, "x", 1.0), (2, "u", 5.0)]
    assert ins == [(3, "z", 3.0)]
    assert rows(merge_upsert(t, d, "id")) == sorted(upd + ins, key=repr)


def test_day_columns_matched_by_name(spark):
    t = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    d = spark.createDataFrame([(2.0, "u", 1)], "b double, a string, id bigint")
    assert rows(merge_upsert(t, d, "id")) == [(1, "u", 2.0)]


def test_dotted_names(spark):
    t = spark.createDataFrame([(1, "x")], "id bigint, `via.channel` string")
    d = spark.createDataFrame([(1, "web"), (2, "mail")], "id bigint, `via.channel` string")
    assert rows(merge_upsert(t, d, "id")) == [(1, "web"), (2, "mail")]


row = st.tuples(
    st.one_of(st.none(), st.integers(0, 6)),
    st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
    st.one_of(st.none(), st.floats(-5, 5, allow_nan=False).map(lambda x: round(x, 2))),
)


def unique_day(rows_):
    seen, out = set(), []
    for r in rows_:
        if r[0] is not None and r[0] in seen:
            continue
        seen.add(r[0])
        out.append(r)
    return out


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=8), st.lists(row, max_size=6).map(unique_day))
def test_matches_model(spark, target, day):
    t = spark.createDataFrame(target, SCHEMA)
    d = spark.createDataFrame(day, SCHEMA)
    assert rows(merge_upsert(t, d, "id")) == model_merge(target, day)


def test_properties(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (None, "n", 0.0)], SCHEMA)
    d = spark.createDataFrame([(2, "u", 5.0), (3, "z", 3.0)], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    once = merge_upsert(t, d, "id")
    # merge twice == merge once (same day re-applied)
    assert rows(merge_upsert(once, d, "id")) == rows(once)
    # empty day leaves the target
    assert rows(merge_upsert(t, empty, "id")) == rows(t)
    # empty target becomes the day
    assert rows(merge_upsert(empty, d, "id")) == rows(d)


def test_match_pairs_every_duplicate_and_never_nulls(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (1, "x2", 1.5), (None, "n", 0.0), (2, "y", 2.0)], SCHEMA)
    d = spark.createDataFrame([(1, "new", 9.0), (None, "m", 8.0), (3, "z", 3.0)], SCHEMA)
    got = sorted((r["target"]["a"], r["day"]["a"]) for r in merge_match(t, d, "id").collect())
    assert got == [("x", "new"), ("x2", "new")]


@pytest.fixture()
def no_broadcast(spark):
    """Joins as with a day too big to broadcast, and no help from AQE."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def hot_target(spark, n=30_000):
    """A third of the rows under key 1, a sixth under null."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(1)).when(i % 6 == 1, F.lit(None)).otherwise(i)
    return spark.range(n).select(key.alias("id"), i.cast("string").alias("a"), (i * 1.0).alias("b"))


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return re.sub(r"\*\(\d+\) ", "", buf.getvalue())


def test_big_day_with_hot_target_key(spark, no_broadcast):
    # one key holds a third of the target; the day is too big to broadcast,
    # so the target keys are pre-aggregated before their shuffle
    t = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("id"),
        F.col("id").cast("string").alias("a"), (F.col("id") * 1.0).alias("b"),
    )
    d = spark.range(0, 3500, 7).select("id", F.lit("new").alias("a"), F.lit(-1.0).alias("b"))
    m = merge_upsert(t, d, "id", day_rows=500)
    assert rows(m) == model_merge([tuple(r) for r in t.collect()], [tuple(r) for r in d.collect()])
    plan = plan_of(m)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    # target keys: partial aggregate -> exchange -> final aggregate -> semi join
    semi = plan[plan.index("LeftSemi"):]
    agg = r"HashAggregate\(keys=\[__tl_k#\d+L\], functions=\[\]\)"
    assert re.search(agg + r"\s*\n[\s:]*\+- Exchange hashpartitioning[^\n]*\n[\s:]*\+- " + agg, semi)


def test_hot_keys_are_found_by_the_sketch(spark):
    t = hot_target(spark)
    assert hot_keys(t, "id", parts=8, least=100) == {1: 3, None: 2}
    assert hot_keys(t, "id", parts=8, least=6000) == {1: 3}
    assert hot_keys(t, "id", parts=8) == {}  # fewer rows than are worth a task
    assert hot_keys(t.limit(0), "id") == {} and hot_keys(t, "b") == {}
    assert hot_keys(t.where("id = 1"), "id", parts=8, least=1) == {1: 8}


def test_hot_keys_are_dealt_over_tasks(spark, no_broadcast):
    """Half the rows under two keys: no task of the join holds more than three times the median."""
    t, d = hot_target(spark).repartition(4), spark.range(0, 35_000, 7).select("id", F.lit("new").alias("a"), F.lit(-1.0).alias("b"))
    hot = hot_keys(t, "id", parts=8, least=100)

    def sizes(df):
        return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    plain = sizes(merge_update_matched(t, d, "id", hot={}))
    dealt = sizes(merge_update_matched(t, d, "id", hot=hot))
    assert sum(plain) == sum(dealt) == 30_000 and len(dealt) == 8
    assert plain[-1] > 3 * plain[4] and dealt[-1] < 3 * dealt[4]
    pairs = merge_match(t, d.union(spark.createDataFrame([(1, "n", 0.0)], SCHEMA)), "id", hot=hot)
    split = sizes(pairs)
    assert sum(split) > 10_000 and split[-1] < 0.6 * sum(split)


def test_salted_merge_equals_the_model(spark, no_broadcast):
    t = hot_target(spark, 600)
    d = spark.createDataFrame([(1, "one", 0.5), (None, "null", None), (7, None, 7.0), (9999, "new", 1.0), (13, "x", None)], SCHEMA)
    hot = {1: 4, None: 3, 9999: 2}
    want = model_merge([tuple(r) for r in t.collect()], [tuple(r) for r in d.collect()])
    assert rows(merge_upsert(t, d, "id", hot=hot)) == want == rows(merge_upsert(t, d, "id"))
    matched = [r for r in t.collect() if r["id"] in (1, 7, 13)]
    assert merge_match(t, d, "id", hot=hot).count() == len(matched)


def test_day_keys_pass_their_filter(spark):
    d = spark.range(0, 40_000, 4)
    test = key_filter(d, "id", 10_000)
    assert d.where(~test(F.col("id"))).count() == 0
    wrong = spark.range(40_000).where("id % 4 <> 0").where(test(F.col("id"))).count()
    assert wrong < 30_000 / 100
    text = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("id"))
    test = key_filter(text.where("id < 'k2'"), "id", 1200)
    assert text.where(test(F.col("id"))).where("id < 'k2'").count() == text.where("id < 'k2'").count()
    assert spark.range(10).where(key_filter(spark.range(0), "id", 0)(F.col("id"))).count() == 0


def shuffled_bytes(df):
    """Bytes that the executed plan's shuffles wrote."""
    df.collect()
    node, total, todo = None, 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        metrics = node.metrics()
        if metrics.contains("shuffleBytesWritten") and "Exchange" in node.nodeName():
            total += metrics.apply("shuffleBytesWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_filter_keeps_target_keys_from_moving(spark, no_broadcast, monkeypatch):
    t = spark.range(0, 200_000).repartition(4).select("id", F.lit("a").alias("a"), F.lit(1.0).alias("b"))
    d = spark.range(0, 400_000, 100).select("id", F.lit("new").alias("a"), F.lit(-1.0).alias("b"))
    t.cache().count()
    filtered = merge_insert_unmatched(t, d, "id", 4000)
    few, got = shuffled_bytes(filtered), rows(filtered)
    monkeypatch.setattr(merge, "day_key_test", lambda *a: None)
    plain = merge_insert_unmatched(t, d, "id", 4000)
    many = shuffled_bytes(plain)
    t.unpersist()
    assert got == rows(plain) and len(got) == 2000
    assert few < many / 4


def test_keys_of_other_types_are_not_filtered(spark):
    t = spark.createDataFrame([("02", "x", 1.0), ("3", "y", 1.0)], "id string, a string, b double")
    d = spark.createDataFrame([(2, "new", 2.0), (4, "z", 2.0)], SCHEMA)
    assert merge.day_key_test(t, d, "id", 2) is None
    assert rows(merge_insert_unmatched(t, d, "id")) == [(4, "z", 2.0)]
