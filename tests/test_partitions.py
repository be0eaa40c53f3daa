"""Partition-granular copy-on-write merge."""

import uuid
from collections import defaultdict

from pyspark.sql import functions as F

from tableload.plans.partitions import partition_value, publish_partitioned, table_partitions, upsert_partitions

SCHEMA = "id bigint, s string, p string"


def files_by_partition(spark, table):
    out = defaultdict(set)
    for f in spark.table(table).inputFiles():
        seg = [x for x in f.split("/") if x.startswith("p=")][0]
        out[seg[2:]].add(f.rsplit("/", 2)[0])
    return out


def test_only_touched_partitions_rewritten(spark, tmp_root):
    t = f"pt_{uuid.uuid4().hex[:8]}"
    rows = [(1, "a", "2024-01"), (2, "b", "2024-02"), (3, "c", "2024-03"), (4, "d", "2024-04")]
    publish_partitioned(spark, spark.createDataFrame(rows, SCHEMA), t, tmp_root, "p")
    before = files_by_partition(spark, t)
    day = spark.createDataFrame(
        [
            (2, "B", "2024-02"),  # update in place
            (4, "D", "2024-05"),  # moves out of 2024-04, which ends empty
            (5, "e", "2024-06"),  # new partition
        ],
        SCHEMA,
    )
    touched = upsert_partitions(spark, t, day, "id", "p", tmp_root)
    assert touched == ["2024-02", "2024-04", "2024-05", "2024-06"]
    got = sorted(tuple(r) for r in spark.table(t).collect())
    assert got == [(1, "a", "2024-01"), (2, "B", "2024-02"), (3, "c", "2024-03"), (4, "D", "2024-05"), (5, "e", "2024-06")]
    after = files_by_partition(spark, t)
    assert after["2024-01"] == before["2024-01"] and after["2024-03"] == before["2024-03"]
    assert after["2024-02"] != before["2024-02"]
    assert table_partitions(spark, t, "p") == {"2024-01", "2024-02", "2024-03", "2024-05", "2024-06"}


def test_partition_value_and_pruned_read(spark, tmp_root):
    df = spark.createDataFrame([(1, "2024-01-31 23:59:59"), (2, None)], "id bigint, ts string").select(
        "id", partition_value(F.col("ts").cast("timestamp_ntz"), "yyyy-MM").alias("p")
    )
    assert sorted(r["p"] for r in df.collect()) == ["2024-01", "none"]
    t = f"pt_{uuid.uuid4().hex[:8]}"
    publish_partitioned(spark, df.withColumn("s", F.lit("x")), t, tmp_root, "p")
    assert spark.table(t).columns == ["id", "s", "p"]
    plan = spark.table(t).where(F.col("p") == "2024-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_empty_day_touches_nothing(spark, tmp_root):
    t = f"pt_{uuid.uuid4().hex[:8]}"
    publish_partitioned(spark, spark.createDataFrame([(1, "a", "x")], SCHEMA), t, tmp_root, "p")
    assert upsert_partitions(spark, t, spark.createDataFrame([], SCHEMA), "id", "p", tmp_root) == []
    assert [tuple(r) for r in spark.table(t).collect()] == [(1, "a", "x")]


def test_big_day_with_hot_key_touches_the_same_partitions(spark, tmp_root):
    # a third of the target shares key 1 (all in 2024-01); the day is big, so
    # the (key, partition) pairs are pre-aggregated before their shuffle
    t = f"pt_{uuid.uuid4().hex[:8]}"
    rows = [(1, f"x{i}", "2024-01") for i in range(30)] + [(i, "y", f"2024-0{2 + i % 3}") for i in range(2, 62)]
    publish_partitioned(spark, spark.createDataFrame(rows, SCHEMA), t, tmp_root, "p")
    day = spark.createDataFrame([(1, "new", "2024-01"), (3, "Y", "2024-03"), (99, "z", "2024-09")], SCHEMA)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        touched = upsert_partitions(spark, t, day, "id", "p", tmp_root, day_rows=10**9)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert touched == ["2024-01", "2024-02", "2024-03", "2024-09"]  # key 3 moves out of 2024-02
    got = spark.table(t)
    assert got.where("id = 1").select("s").distinct().collect()[0][0] == "new"
    assert got.where("id = 1").count() == 30 and got.count() == 91
    assert got.where("id = 3").collect()[0]["s"] == "Y" and got.where("id = 99").count() == 1


def test_partitioned_write_is_clustered(spark, tmp_root):
    # rows of every partition spread over 8 tasks: still one file per (small) partition
    t = f"pt_{uuid.uuid4().hex[:8]}"
    df = spark.range(4000).repartition(8).select(
        "id", F.lit("x").alias("s"), F.format_string("2024-%02d", (F.col("id") % 12 + 1).cast("int")).alias("p")
    )
    publish_partitioned(spark, df, t, tmp_root, "p")
    assert len(spark.table(t).inputFiles()) == 12 and spark.table(t).count() == 4000
