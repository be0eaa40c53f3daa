"""Loads that report, can be cancelled, and scripts as one text."""

import json
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pages_helper import write_pages
from tableload.plans import pipelines
from tableload.plans.pipelines import DEMO_SCRIPT, LoadPaths, LoadResult, ObjectLoads, full_load, incremental_load, load_all_objects, script_text_load
from tableload.schemas import DEMO_LITERAL_ROWS, DEMO_PARAMS, ObjectSpec, parse_columns
from tableload.sources.pages import wire_report

ITEMS = ObjectSpec("items", parse_columns("id bigint\nname string 8\nfrom.city string 16\nfrom.zip bigint\ntags array<string>\nnote string"), time_column=None)


def page(records, number=0, last=True):
    return {"items": records, "page": number, "end_of_stream": last, "next_page": None}


# what the wire carries


def report(spark, root, name, pages):
    path = write_pages(root, name, pages)
    return {r["column_name"]: (r["finding"], r["wire_type"], r["n_records"]) for r in wire_report(spark, ITEMS, path).collect()}


def test_wire_report_names_extra_and_absent_keys(spark, tmp_root):
    pages = [
        page([{"id": 1, "name": "a", "from": {"city": "x", "street": "y"}, "it's": 1, "a.b": 2, "o'\"": 3}, {"id": 2, "name": None, "tags": ["t"]}], 0, False),
        page([{"id": 3, "name": "b", "from": None, "new": {"deep": {"er": 1.5}}}, {"id": 12345678901234567890}], 1),
    ]
    assert report(spark, tmp_root, "mixed", pages) == {
        "id": ("kept", "number", 4),
        "name": ("kept", "string", 2),
        "from.city": ("kept", "string", 1),
        "from.street": ("extra", "string", 1),
        "it's": ("extra", "bigint", 1),
        "a.b": ("extra", "bigint", 1),
        "o'\"": ("extra", "bigint", None),
        "tags": ("kept", "array<string>", 1),
        "new.deep.er": ("extra", "number", 1),
        "from.zip": ("absent", None, 0),
        "note": ("absent", None, 0),
    }


def test_wire_report_of_a_key_of_two_kinds(spark, tmp_root):
    got = report(spark, tmp_root, "kinds", [page([{"id": 1, "from": "home", "note": 1}, {"id": 2, "from": {"city": "x"}, "note": "two"}])])
    assert got["from"] == ("extra", "variant", 2) and got["note"] == ("kept", "variant", 2) and got["from.city"][0] == "absent"


def test_wire_report_without_records(spark, tmp_root):
    got = report(spark, tmp_root, "none", [page([])])
    assert {f for f, *_ in got.values()} == {"absent"} and set(got) == set(ITEMS.names)


# counts taken while writing


def land(root, paths, rows, day="2024-01-16"):
    write_pages(f"{paths.landing}/items/full", f"ds={day}", [page(rows)])
    write_pages(f"{paths.landing}/items", f"ds={day}", [page(rows)])


@pytest.fixture()
def paths(tmp_root):
    return LoadPaths(landing=f"{tmp_root}/landing", stage=f"{tmp_root}/stage", tables=f"{tmp_root}/tables")


def test_loads_count_while_they_write(spark, paths, tmp_root, monkeypatch):
    land(tmp_root, paths, [{"id": i, "name": "n" * (i % 8), "from": {"city": "c"}} for i in range(30)])

    def no_count(self):
        raise AssertionError("a second pass")

    monkeypatch.setattr(DataFrame, "count", no_count)
    monkeypatch.setattr(type(spark.range(0)), "count", no_count)
    table = f"items_{time.time_ns()}"
    full = full_load(spark, ITEMS, "2024-01-16", paths, table)
    daily = incremental_load(spark, ITEMS, "2024-01-16", paths, table)
    assert (full.rows, daily.rows) == (30, 30)
    assert full.longest == daily.longest == {"name": 7, "from.city": 1}


def test_empty_day_is_counted(spark, paths, tmp_root):
    land(tmp_root, paths, [])
    table = f"items_{time.time_ns()}"
    assert full_load(spark, ITEMS, "2024-01-16", paths, table).rows == 0
    res = incremental_load(spark, ITEMS, "2024-01-16", paths, table)
    assert res.rows == 0 and res.longest == {"name": 0, "from.city": 0}


# loads side by side


def slow(spark):
    def wait(batches):
        for b in batches:
            for _ in range(3000):
                time.sleep(0.1)
                yield b.iloc[:0]

    return spark.range(4).mapInPandas(wait, "id long").collect()


def test_one_load_is_cancelled_and_the_others_go_on(spark, monkeypatch):
    specs = [ObjectSpec(n, ITEMS.columns) for n in ("quick", "stuck", "later")]
    tried = []

    def load(spark, spec, ds, paths, table, given_up):
        tried.append(spec.name)
        if spec.name == "stuck":
            try:
                slow(spark)
            except Exception:
                assert given_up()
                raise
        return LoadResult(table, "daily", rows=spark.range(5).count())

    monkeypatch.setattr(pipelines, "load_with_fallback", load)
    loads = ObjectLoads(spark, specs, "2024-01-16", None, parallel=2)
    began = time.time()
    while not spark.sparkContext.statusTracker().getActiveJobsIds():
        time.sleep(0.05)
    assert loads.cancel("stuck").branch == "cancelled"
    res = loads.wait()
    assert time.time() - began < 60
    assert {n: r.branch for n, r in res.items()} == {"quick": "daily", "stuck": "cancelled", "later": "daily"}
    assert sorted(tried) == ["later", "quick", "stuck"] and res["later"].rows == 5


def test_cancelled_before_it_starts(spark, monkeypatch):
    started = []
    monkeypatch.setattr(pipelines, "load_with_fallback", lambda spark, spec, *a, **k: (started.append(spec.name), time.sleep(1), LoadResult(spec.name, "daily"))[-1])
    specs = [ObjectSpec(n, ITEMS.columns) for n in ("a", "b")]
    loads = ObjectLoads(spark, specs, "2024-01-16", None, parallel=1)
    while not started:
        time.sleep(0.01)
    waiting = "b" if started == ["a"] else "a"
    assert loads.cancel(waiting).branch == "cancelled"
    assert loads.wait()[started[0]].branch == "daily" and len(started) == 1


def test_jobs_carry_their_objects_tag(spark, monkeypatch):
    tags = {}
    monkeypatch.setattr(pipelines, "load_with_fallback", lambda spark, spec, *a, **k: (tags.update({spec.name: spark.sparkContext.getJobTags()}), LoadResult(spec.name, "daily"))[-1])
    load_all_objects(spark, [ObjectSpec(n, ITEMS.columns) for n in ("a", "b")], "2024-01-16", None)
    assert {n: [t.split("-")[-1] for t in ts] for n, ts in tags.items()} == {"a": ["a"], "b": ["b"]}
    assert not spark.sparkContext.getJobTags()


def test_a_given_up_load_does_not_fall_back(spark, paths, monkeypatch):
    monkeypatch.setattr(pipelines, "full_load", lambda *a, **k: pytest.fail("fell back"))
    with pytest.raises(PySparkException):
        pipelines.load_with_fallback(spark, ITEMS, "2024-01-16", paths, "no_such_table", given_up=lambda: True)


# scripts


def test_demo_script_from_its_text(spark, tmp_root):
    table = f"demo_{time.time_ns()}"
    got = script_text_load(spark, DEMO_SCRIPT, "2024-01-16", table, f"{tmp_root}/{table}")
    want = [*DEMO_LITERAL_ROWS, (*DEMO_PARAMS.values(), "2024-01-16")]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{table}__s")]


def test_failing_statement_leaves_the_table(spark, tmp_root):
    table = f"demo_{time.time_ns()}"
    before = script_text_load(spark, DEMO_SCRIPT, "2024-01-16", table, f"{tmp_root}/{table}").collect()
    bad = "INSERT INTO IDENTIFIER(:target) SELECT raise_error('no'), 'b', 'c';\nEND".join(DEMO_SCRIPT.rsplit("END", 1))
    with pytest.raises(PySparkException):
        script_text_load(spark, bad, "2024-01-17", table, f"{tmp_root}/{table}")
    assert sorted(spark.table(table).collect()) == sorted(before)
    with pytest.raises(ValueError, match="made no table"):
        script_text_load(spark, "BEGIN SELECT 1; END", "2024-01-17", table, f"{tmp_root}/{table}")
    assert not [t.name for t in spark.catalog.listTables() if "__s" in t.name or t.name.startswith("tl_")]


def test_script_values_are_data(spark, tmp_root):
    table = f"demo_{time.time_ns()}"
    value = "x'); DROP TABLE t; --"
    got = script_text_load(spark, DEMO_SCRIPT, "2024-01-16", table, f"{tmp_root}/{table}", args={"value_1": value})
    assert value in {r["col_1"] for r in got.collect()}


def test_script_reads_frames_and_loops(spark, tmp_root):
    table = f"demo_{time.time_ns()}"
    text = """BEGIN
      DECLARE n INT DEFAULT 0;
      CREATE TABLE IDENTIFIER(:target) (k BIGINT, n INT) USING parquet;
      WHILE n < 3 DO
        INSERT INTO IDENTIFIER(:target) SELECT id, n FROM IDENTIFIER(:numbers);
        SET n = n + 1;
      END WHILE;
    END"""
    got = script_text_load(spark, text, "2024-01-16", table, f"{tmp_root}/{table}", sources={"numbers": spark.range(4)})
    assert sorted(map(tuple, got.collect())) == sorted((k, n) for k in range(4) for n in range(3))
    assert json.loads(got.agg(F.to_json(F.struct(F.count("*").alias("c")))).first()[0]) == {"c": 12}
