"""Bucketed targets: big-day merges shuffle only the day."""

import contextlib
import io
import uuid

from pyspark.sql import functions as F

from tableload.operators.merge import merge_upsert
from tableload.plans.buckets import publish_bucketed, table_buckets

SCHEMA = "id bigint, s string"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :|+-"))


def test_publish_and_republish(spark, tmp_root):
    t = f"bt_{uuid.uuid4().hex[:8]}"
    publish_bucketed(spark, spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), t, tmp_root, "id", 4)
    assert table_buckets(spark, t) == (4, ["id"])
    day = spark.createDataFrame([(2, "B"), (3, "c")], SCHEMA)
    publish_bucketed(spark, merge_upsert(spark.table(t), day, "id"), t, tmp_root, "id", 4)
    assert sorted(map(tuple, spark.table(t).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert table_buckets(spark, t) == (4, ["id"])


def test_big_day_merge_does_not_shuffle_target(spark, tmp_root):
    t = f"bt_{uuid.uuid4().hex[:8]}"
    target = spark.range(2000).select(F.col("id"), F.col("id").cast("string").alias("s"))
    publish_bucketed(spark, target, t, tmp_root, "id", 8)
    day = spark.range(1500, 2500).select(F.col("id"), F.lit("new").alias("s"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the day were big
        merged = merge_upsert(spark.table(t), day, "id", check_unique=False)
        plan = plan_of(merged)
        got = merged.groupBy("s").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "Bucketed: true" in line]
    assert len(scans) == 2  # the target is read twice: whole rows, and keys only
    for i in scans:  # walk up the tree from each target scan to its join: no exchange on the way
        depth = indent(lines[i])
        for line in reversed(lines[:i]):
            if indent(line) < depth:
                depth = indent(line)
                if "SortMergeJoin" in line:
                    break
                assert "Exchange" not in line, line
    counts = {r["s"]: r["count"] for r in got}
    assert counts["new"] == 1000 and sum(counts.values()) == 2500


def test_bucketed_publish_writes_one_file_per_bucket(spark, tmp_root):
    t = f"bt_{uuid.uuid4().hex[:8]}"
    df = spark.range(4000).repartition(8).select("id", F.lit("x").alias("s"))
    publish_bucketed(spark, df, t, tmp_root, "id", 4)
    assert len(spark.table(t).inputFiles()) == 4 and spark.table(t).count() == 4000


def test_hot_bucket_is_split_over_tasks(spark, tmp_root):
    # a third of the rows share one key: its bucket gets several files (written
    # by several tasks); the table still reads bucketed, with no exchange
    t = f"bt_{uuid.uuid4().hex[:8]}"
    df = spark.range(300000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("id"), F.lit("x" * 20).alias("s")
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        publish_bucketed(spark, df, t, tmp_root, "id", 4)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = spark.table(t).inputFiles()
    buckets = [f.rsplit("_", 1)[-1].split(".")[0] for f in files]
    assert len(set(buckets)) == 4 and len(files) > 4
    assert spark.table(t).where("id = 7").count() == 100001  # 100,000 rewritten ids plus id 7 itself
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        spark.table(t).groupBy("id").count().explain()
    assert "Exchange" not in buf.getvalue()
