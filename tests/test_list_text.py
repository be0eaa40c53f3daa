"""List text in Python's form, as pandas writes a list into a CSV cell."""

import ast
import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tableload.functions.casts import json_text, python_json, text_array
from tableload.schemas import ObjectSpec, parse_columns
from tableload.sources.stage import csv_stage_scan, csv_stage_write, typed_load

BITS = ["a", "Z", " ", "'", '"', "\\", "\n", "\t", "\r", "é", "日", "😀", "\x00", "\x1f", "\x7f", "​", "\U000e0041", "[", "]", ",", "None", "{", "}", ":", "#", "1.0"]


def text(rng):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, 12)))


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 6)
    if kind < 3:
        return text(rng)
    if kind == 6:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    if kind == 7:
        return {text(rng): value(rng, depth + 1) for _ in range(rng.randint(0, 4))}
    return rng.choice([None, True, False, rng.randint(-(10**15), 10**15), rng.randint(-9, 9) / 4, 1e-7, 2.5e22])


def column(spark, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r["y"] for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


def test_python_literals_against_their_parser(spark):
    rng = random.Random(12)
    rows = [repr([value(rng) for _ in range(rng.randint(0, 5))]) for _ in range(400)] + ["['" + "x" * 200_000 + "\\'" * 50_000 + "']"]
    got = column(spark, rows, python_json(F.col("x")))
    for x, y in zip(rows, got, strict=True):
        assert json.loads(y, strict=False) == ast.literal_eval(x)


def test_json_stays(spark):
    rng = random.Random(13)
    rows = [json.dumps([value(rng)], ensure_ascii=rng.random() < 0.5) for _ in range(150)]
    for x, y in zip(rows, column(spark, rows, python_json(F.col("x"))), strict=True):
        assert json.loads(y) == json.loads(x)


def test_text_lists(spark):
    rng = random.Random(14)
    lists = [[rng.choice([None, text(rng)]) for _ in range(rng.randint(0, 5))] for _ in range(200)]
    assert column(spark, [repr(v) for v in lists], text_array(F.col("x"), "string", "tags")) == lists
    ids = [[rng.choice([None, 7, -3, 9_000_000_000_000]) for _ in range(4)] for _ in range(50)]
    assert column(spark, [repr(v) for v in ids], text_array(F.col("x"), "bigint", "ids")) == ids
    as_float = [repr([None if v is None else float(v) for v in r]) for r in ids]
    assert column(spark, as_float, text_array(F.col("x"), "bigint", "ids")) == ids
    assert column(spark, [None, "[]"], text_array(F.col("x"), "string", "tags")) == [None, []]


@pytest.mark.parametrize("bad", ["['a'", "['a' 'b", "[a]", "['\\q']", "nope", "", "[1, @]", "['\\x4']", "[nan]", "'a', 'b'"])
def test_bad_list_text_fails(spark, bad):
    with pytest.raises(PySparkException, match="bad list text in tags"):
        column(spark, [bad], text_array(F.col("x"), "string", "tags"))


@pytest.mark.parametrize("bad", ["[12.5]", "['a']", "[1, None, 'x']"])
def test_bad_id_lists_fail(spark, bad):
    with pytest.raises(PySparkException, match="bad list text in ids"):
        column(spark, [bad], text_array(F.col("x"), "bigint", "ids"))


def test_lists_of_objects(spark):
    fields = [{"id": 1, "value": None, "open": True, "note": "it's"}, {"id": 2, "value": ["a", "b"]}]
    got = column(spark, [repr(fields), json.dumps(fields), "plain text", None, ""], json_text(F.col("x")))
    assert [json.loads(y) for y in got[:2]] == [fields, fields] and got[2:] == ["plain text", None, ""]


def test_stage_written_by_pandas(spark, tmp_root):
    """A CSV stage whose lists came from pandas loads like one of ours."""
    spec = ObjectSpec("items", parse_columns("item_id bigint\ntags array<string>\nids array<bigint>\nfields json 400"), key="item_id", time_column=None)
    tags, ids, fields = ["it's", 'a "b"', None, "back\\slash", "two\nlines"], [1, None, 3], [{"k": None, "v": "x'y"}]
    rows = [("1.0", repr(tags), repr([1.0, None, 3.0]), repr(fields)), ("2", json.dumps(tags), json.dumps(ids), json.dumps(fields)), ("3", None, None, None)]
    df = spark.createDataFrame(rows, "item_id string, tags string, ids string, fields string")
    path = csv_stage_write(df, f"{tmp_root}/stage")
    got = {r["item_id"]: r for r in typed_load(csv_stage_scan(spark, path, spec.text_schema()), spec).collect()}
    for i in (1, 2):
        assert (got[i]["tags"], got[i]["ids"], json.loads(got[i]["fields"])) == (tags, ids, fields)
    assert got[3]["tags"] is None and got[3]["fields"] is None


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("[]",)], "x string").select(text_array(F.col("x"), "string", "tags"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_each_step_is_computed_once(spark):
    """Tokens and pieces occur once in the expression, and the likely form is tried first: named twice, each level doubles the work."""
    df = spark.createDataFrame([("[]",)], "x string")

    def plan(y):
        return df.select(y.alias("y"))._jdf.queryExecution().analyzed().toString()

    assert plan(python_json(F.col("x"))).count("regexp_extract_all") == 2
    for y in (json_text(F.col("x")), text_array(F.col("x"), "string", "tags")):
        assert plan(y).count("regexp_extract_all") <= 4


def test_either_form_first(spark):
    """JSON text that holds signs of Python's form comes out as JSON; Python's form without any does too."""
    rows = ['["None", "it\'s", "1.0]"]', "[1.50, 2]", '{"a": "True"}', "['a', None]", "[None]"]
    assert column(spark, rows, json_text(F.col("x"))) == [*rows[:3], '["a", null]', "[null]"]
    assert column(spark, [rows[0], rows[3], "[]"], text_array(F.col("x"), "string", "tags")) == [["None", "it's", "1.0]"], ["a", None], []]
    assert column(spark, ["[5.0, 6]", "[5, 6]", "[5.0,null]"], text_array(F.col("x"), "bigint", "ids")) == [[5, 6], [5, 6], [5, None]]
