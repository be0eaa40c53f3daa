"""The file-stream loader: fetch-by-fetch merge, restart from the checkpoint."""

import uuid

from pages_helper import write_pages
from tableload.plans.pipelines import LoadPaths
from tableload.schemas import USERS
from tableload.streaming.landing import drain, stream_load


def user(i, name, updated):
    return {"id": i, "name": name, "updated_at": updated}


def run(spark, watched, paths, table, ckpt):
    return drain(spark, stream_load(spark, USERS, watched, paths, table, checkpoint=ckpt), table)


def test_stream_merges_fetches_and_resumes(spark, tmp_root):
    paths = LoadPaths(landing=f"{tmp_root}/landing", stage=f"{tmp_root}/stage", tables=f"{tmp_root}/tables")
    watched, table, ckpt = f"{tmp_root}/landing/users", f"users_{uuid.uuid4().hex[:8]}", f"{tmp_root}/ckpt"
    write_pages(watched, "fetch=000000", [
        {"users": [user(1, "a", "2024-01-10T00:00:00Z"), user(2, "b", "2024-01-10T00:00:00Z")],
         "next_page": "n", "end_of_stream": False, "page": 1},
        {"users": [user(3, "c", "2024-01-11T00:00:00Z")], "next_page": None, "end_of_stream": True, "page": 2},
        {"users": [user(99, "stale", "2024-01-11T00:00:00Z")], "next_page": None, "end_of_stream": True, "page": 3},
    ])
    got = run(spark, watched, paths, table, ckpt)
    assert sorted((r["id"], r["name"]) for r in got.collect()) == [(1, "a"), (2, "b"), (3, "c")]

    write_pages(watched, "fetch=000001", [
        {"users": [user(2, "b2", "2024-01-12T00:00:00Z"), user(4, "d", "2024-01-12T00:00:00Z")],
         "next_page": None, "end_of_stream": True, "page": 1},
    ])
    got = run(spark, watched, paths, table, ckpt)  # only the new fetch is merged
    assert sorted((r["id"], r["name"]) for r in got.collect()) == [
        (1, "a"), (2, "b2"), (3, "c"), (4, "d")
    ]
    versions_before = spark.table(table).inputFiles()
    got = run(spark, watched, paths, table, ckpt)  # nothing new: table untouched
    assert got.inputFiles() == versions_before


def test_fetches_of_one_batch_fold_to_one_merge(spark, tmp_root):
    # three fetches land before the stream runs: one batch, one merge, and the
    # result equals merging them one after the other
    paths = LoadPaths(landing=f"{tmp_root}/landing", stage=f"{tmp_root}/stage", tables=f"{tmp_root}/tables")
    watched, table, ckpt = f"{tmp_root}/landing/users", f"users_{uuid.uuid4().hex[:8]}", f"{tmp_root}/ckpt"
    write_pages(watched, "fetch=000000", [
        {"users": [user(1, "a", "2024-01-10T00:00:00Z"), user(2, "b", "2024-01-10T00:00:00Z"),
                   user(None, "n0", "2024-01-10T00:00:00Z")],
         "next_page": None, "end_of_stream": True, "page": 1},
        {"users": [user(98, "stale", "2024-01-10T00:00:00Z")], "next_page": None, "end_of_stream": True, "page": 2},
    ])
    write_pages(watched, "fetch=000001", [
        {"users": [user(2, "b2", "2024-01-11T00:00:00Z"), user(3, "c", "2024-01-11T00:00:00Z")],
         "next_page": "n", "end_of_stream": False, "page": 1},
        {"users": [user(None, "n1", "2024-01-11T00:00:00Z")], "next_page": None, "end_of_stream": True, "page": 2},
    ])
    write_pages(watched, "fetch=000002", [
        {"users": [user(3, "c3", "2024-01-12T00:00:00Z")], "next_page": None, "end_of_stream": True, "page": 1},
    ])
    q = stream_load(spark, USERS, watched, paths, table, checkpoint=ckpt)
    got = drain(spark, q, table)
    assert sorted(((r["id"] or 0), r["name"]) for r in got.collect()) == [
        (0, "n0"), (0, "n1"), (1, "a"), (2, "b2"), (3, "c3")
    ]
    assert len(q.recentProgress) == 1  # one micro-batch for the three fetches


def test_duplicate_key_in_one_fetch_fails_the_batch(spark, tmp_root):
    import pytest

    paths = LoadPaths(landing=f"{tmp_root}/landing", stage=f"{tmp_root}/stage", tables=f"{tmp_root}/tables")
    watched, table, ckpt = f"{tmp_root}/landing/users", f"users_{uuid.uuid4().hex[:8]}", f"{tmp_root}/ckpt"
    write_pages(watched, "fetch=000000", [
        {"users": [user(1, "a", "2024-01-10T00:00:00Z")], "next_page": "n", "end_of_stream": False, "page": 1},
        {"users": [user(1, "a2", "2024-01-10T00:00:00Z")], "next_page": None, "end_of_stream": True, "page": 2},
    ])
    from pyspark.errors import StreamingQueryException

    with pytest.raises(StreamingQueryException, match="duplicate id in one fetch"):
        run(spark, watched, paths, table, ckpt)


def land_file(root, name, pages):
    import json
    import os

    os.makedirs(root, exist_ok=True)
    with open(f"{root}/{name}.json", "w") as f:
        f.writelines(json.dumps(p) + "\n" for p in pages)


def test_files_of_one_folder_are_one_fetch(spark, tmp_root):
    import pytest
    from pyspark.errors import StreamingQueryException

    paths = LoadPaths(landing=f"{tmp_root}/landing", stage=f"{tmp_root}/stage", tables=f"{tmp_root}/tables")
    watched, table, ckpt = f"{tmp_root}/landing/users", f"users_{uuid.uuid4().hex[:8]}", f"{tmp_root}/ckpt"
    first = {"users": [user(1, "a", "2024-01-10T00:00:00Z")], "next_page": None, "end_of_stream": True, "page": 0}
    stale = {"users": [user(2, "stale", "2024-01-10T00:00:00Z")], "next_page": None, "end_of_stream": False, "page": 1}
    land_file(f"{watched}/fetch=000000", "part-0", [first])
    land_file(f"{watched}/fetch=000000", "part-1", [stale])
    got = run(spark, watched, paths, table, ckpt)
    assert [(r["id"], r["name"]) for r in got.collect()] == [(1, "a")]  # page 0 of the other file stopped the fetch
    twice = {"users": [user(5, "x", "2024-01-11T00:00:00Z")], "next_page": None, "end_of_stream": False, "page": 0}
    land_file(f"{watched}/fetch=000001", "part-0", [twice])
    land_file(f"{watched}/fetch=000001", "part-1", [{**twice, "page": 1}])
    with pytest.raises(StreamingQueryException, match="duplicate id in one fetch"):
        run(spark, watched, paths, table, ckpt)


def test_repeated_batch_is_merged_once(spark, tmp_root):
    from pyspark.sql import functions as F

    from tableload.sources.pages import read_pages
    from tableload.streaming.landing import FETCH, LANDED, merge_fetches

    paths = LoadPaths(landing=f"{tmp_root}/landing", stage=f"{tmp_root}/stage", tables=f"{tmp_root}/tables")
    table = f"users_{uuid.uuid4().hex[:8]}"
    rows = [user(1, "a", "2024-01-10T00:00:00Z"), user(None, "n", "2024-01-10T00:00:00Z")]
    path = write_pages(f"{tmp_root}/landing/users", "fetch=0", [{"users": rows, "end_of_stream": True, "page": 0}])
    pages = read_pages(spark, path, USERS.envelope_schema())
    pages = pages.withColumns({FETCH: F.lit("fetch=0"), LANDED: F.current_timestamp()})
    for batch in (0, 0, 0):
        merge_fetches(spark, USERS, pages, paths, table, batch, "ckpt")
    assert sorted(r["name"] for r in spark.table(table).collect()) == ["a", "n"]
    merge_fetches(spark, USERS, pages, paths, table, 1, "ckpt")  # a new batch with the same rows
    assert sorted(r["name"] for r in spark.table(table).collect()) == ["a", "n", "n"]


def broken_off(spark, tmp_root, monkeypatch, spec, name, fail_at):
    """A first batch, then a second one that fails at catalog call ``fail_at`` of its publish and is run again."""
    from pyspark.sql import functions as F

    from tableload.plans import partitions
    from tableload.sources.pages import read_pages
    from tableload.streaming.landing import FETCH, LANDED, merge_fetches

    paths = LoadPaths(landing=f"{tmp_root}/landing", stage=f"{tmp_root}/stage", tables=f"{tmp_root}/tables")
    table = f"users_{uuid.uuid4().hex[:8]}"

    def batch(number, rows):
        path = write_pages(f"{tmp_root}/landing/{name}", f"fetch={number}", [{"users": rows, "end_of_stream": True, "page": 0}])
        pages = read_pages(spark, path, USERS.envelope_schema()).withColumns({FETCH: F.lit(f"fetch={number}"), LANDED: F.current_timestamp()})
        return lambda: merge_fetches(spark, spec, pages, paths, table, number, "ckpt")

    def made(i, n, month):
        return {**user(i, n, "2024-03-01T00:00:00Z"), "created_at": f"2024-{month:02d}-10T00:00:00Z"}

    batch(0, [made(1, "a", 1), made(2, "b", 2), made(None, "n0", 1)])()
    second = batch(1, [made(1, "a2", 2), made(2, "b2", 1), made(3, "c", 3), made(None, "n1", 1), made(None, "n2", 2)])
    calls, sql = [], type(spark).sql

    def failing(self, text, *a, **k):
        if "LOCATION" in text or "TBLPROPERTIES (" in text:
            calls.append(text)
            if len(calls) == fail_at:
                raise RuntimeError("the driver is gone")
        return sql(self, text, *a, **k)

    monkeypatch.setattr(type(spark), "sql", failing)
    try:
        second()
    except RuntimeError:
        pass
    monkeypatch.setattr(type(spark), "sql", sql)
    assert partitions  # the module whose calls fail
    second()
    second()
    return sorted((r["name"], str(r["created_at"])[:7]) for r in spark.table(table).collect()), len(calls)


AFTER = [("a2", "2024-02"), ("b2", "2024-01"), ("c", "2024-03"), ("n0", "2024-01"), ("n1", "2024-01"), ("n2", "2024-02")]


def test_batch_number_is_switched_with_the_data(spark, tmp_root, monkeypatch):
    """No crash, then one at any catalog call: rows without a key are in once."""
    for fail_at in (0, 1, 2):
        got, calls = broken_off(spark, tmp_root, monkeypatch, USERS, f"plain{fail_at}", fail_at)
        assert got == AFTER and calls == 1


def test_broken_off_batch_is_taken_up_by_partition(spark, tmp_root, monkeypatch):
    spec = USERS.with_partition("created_month", "created_at", "yyyy-MM")
    for fail_at in (2, 3, 4):
        got, calls = broken_off(spark, tmp_root, monkeypatch, spec, f"parts{fail_at}", fail_at)
        assert got == AFTER and calls == fail_at


# Folding fetches, then one merge == merging the fetches one after the other.
from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from test_merge import SCHEMA, model_merge, row, rows, unique_day  # noqa: E402


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=6), st.lists(st.lists(row, max_size=5).map(unique_day), min_size=1, max_size=3))
def test_fold_then_merge_equals_sequential_merges(spark, target, fetches):
    import datetime

    from tableload.operators.merge import merge_upsert
    from tableload.streaming.landing import FETCH, LANDED, fold_fetches

    expected = target
    for f in fetches:
        expected = model_merge(expected, f)
    base = datetime.datetime(2024, 1, 1)
    tagged = [
        r + (f"file:/landing/fetch={i:06d}/part-0.json", base + datetime.timedelta(seconds=i))
        for i, f in enumerate(fetches) for r in f
    ]
    recs = spark.createDataFrame(tagged, SCHEMA + f", {FETCH} string, {LANDED} timestamp")
    day = fold_fetches(recs, "id", ["id", "a", "b"])
    got = merge_upsert(spark.createDataFrame(target, SCHEMA), day, "id")
    assert rows(got) == sorted(expected, key=repr)


def test_fold_plan_broadcasts_stops_and_shuffles_only_by_key(spark, tmp_root):
    import contextlib
    import io

    from pyspark.sql import functions as F

    from tableload.streaming.landing import FETCH, LANDED, fetch_records, fold_fetches

    watched = f"{tmp_root}/landing/users"
    for i in range(2):
        write_pages(watched, f"fetch={i:06d}", [
            {"users": [user(1, f"a{i}", "2024-01-10T00:00:00Z")], "next_page": None, "end_of_stream": True, "page": 1},
        ])
    env = USERS.envelope_schema()
    pages = spark.read.schema(env).json(watched).select(
        *[F.col(f.name) for f in env.fields],
        F.col("_metadata.file_path").alias(FETCH), F.col("_metadata.file_modification_time").alias(LANDED),
    )
    day = fold_fetches(fetch_records(pages, USERS), USERS.key, USERS.names)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        day.explain()
    plan = buf.getvalue()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan  # per-fetch stops
    # records cross the network once, by key; by fetch only the stop rows do
    import re

    assert len(re.findall(r"Exchange hashpartitioning\(id#\d+L?, \d+\)", plan)) == 1
    assert not re.search(r"hashpartitioning\(id#\d+L?, __tl_fetch", plan)
    for m in re.finditer(r"Exchange hashpartitioning\(__tl_fetch#\d+, \d+\)[^\n]*\n[\s:]*\+- HashAggregate\(keys=\[__tl_fetch#\d+\], functions=\[(\w+)", plan):
        assert m.group(1) == "partial_min"
    assert [r["name"] for r in day.collect()] == ["a1"]
