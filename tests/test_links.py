"""Page order from links, and the stop read from the header set."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fixtures.landing import land_pages
from pages_helper import write_pages
from tableload.operators.links import link_key, order_links
from tableload.schemas import TICKETS, USERS, ObjectSpec, parse_columns
from tableload.sources.pages import HEADERS, full_source, landed_pages, page_source, read_headers, store_headers, wire_records

HOST = "https://example.invalid/api/v2/incremental/users.json"


def links(spark, rows):
    return spark.createDataFrame(rows, "own string, next string, ended boolean")


def ranks(df):
    return {r["own"]: r["page"] for r in order_links(df).collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 8, 133])
def test_shuffled_cursors_come_in_order(spark, n):
    names = [f"c{i * 7919 % 1009}" for i in range(n)]
    # the first request has no link, pages come as one to three documents, the last one's cursor was not fetched
    rows = [(names[i] if i else "", names[i + 1] if i + 1 < n else "later", i + 1 == n) for i in range(n) for _ in range(1 + i % 3)]
    random.Random(n).shuffle(rows)
    assert ranks(links(spark, rows).repartition(5)) == {(name if i else ""): i for i, name in enumerate(names)}


def test_ends(spark):
    assert ranks(links(spark, [])) == {}
    assert ranks(links(spark, [("a", None, False)])) == {"a": 0}  # no page is flagged: the list ends without a link
    assert ranks(links(spark, [("a", "b", None), ("b", "b", True)])) == {"a": 0, "b": 1}  # the last link asks for the same time again
    # a stale fetch went on after the stop: its pages are numbered on
    assert ranks(links(spark, [("a", "b", False), ("b", "c", True), ("c", None, True)])) == {"a": 0, "b": 1, "c": 2}


@pytest.mark.parametrize(
    "rows, said",
    [
        ([("a", "b", False), ("c", None, True)], "not landed.*b"),
        ([("a", "b", False)], "not landed"),
        ([("a", "b", False), ("b", "a", False)], "circle"),
        ([("a", "a", False)], "circle"),
        ([("a", "b", False), ("b", None, True), ("x", "y", False), ("y", "z", False), ("z", "x", False)], "circle"),
        ([("a", "c", False), ("b", "c", False), ("c", None, True)], "several pages carry.*c"),
        ([("a", None, True), ("b", None, True)], "2 lists"),
        ([("a", "b", False), ("a", "c", False), ("b", "c", False), ("c", None, True)], "several next links.*a"),
        ([("a", "b", False), ("a", None, False), ("b", None, True)], "several next links.*a"),
    ],
)
def test_broken_lists_fail(spark, rows, said):
    with pytest.raises(ValueError, match=said):
        order_links(links(spark, rows))


def test_link_key(spark):
    given = [None, f"{HOST}?start_time=15", f"{HOST}?per_page=2&cursor=MTU3OTI%3D", "MTU3OTI%3D", "https://example.invalid/x"]
    df = spark.createDataFrame([(x,) for x in given], "link string").select(link_key(F.col("link")))
    assert [r[0] for r in df.collect()] == ["", "start_time=15", "MTU3OTI%3D", "MTU3OTI%3D", "https://example.invalid/x"]


def time_pages(n, flagged=None):
    """Pages in the time-paged form: each answers a start time and names the next one."""
    return [
        {"users": [{"id": 10 * i}, {"id": 10 * i + 1}], "request": f"{HOST}?start_time={100 * i}", "next_page": f"{HOST}?start_time={100 * i + 100}", "end_of_stream": i == (n - 1 if flagged is None else flagged)}
        for i in range(n)
    ]


def user_ids(pages):
    return sorted(int(r["id"]) for r in wire_records(pages, USERS.with_links()).select("id").collect())


def test_landing_in_link_order(spark, tmp_root):
    spec = USERS.with_links()
    pages = time_pages(9)
    random.Random(1).shuffle(pages)
    path = write_pages(tmp_root, "linked", pages)
    got = page_source(spark, spec, path).select("page", F.col("users")[0]["id"].alias("id")).collect()
    assert sorted((r["page"], int(r["id"])) for r in got) == [(i, 10 * i) for i in range(9)]


def test_stop_follows_the_links(spark, tmp_root):
    """Page 4 ends the stream; 5 to 8 are on file too and stay out, whatever the order of the files."""
    spec = USERS.with_links()
    # page 8 ends as well (its fetch stopped there), so the list is whole
    pages = time_pages(9, flagged=4)
    pages[8]["end_of_stream"] = True
    random.Random(2).shuffle(pages)
    path = write_pages(tmp_root, "stopped", pages)
    want = sorted(x for i in range(5) for x in (10 * i, 10 * i + 1))
    assert user_ids(landed_pages(spark, spec, path)) == want
    store_headers(spark, spec, path)
    assert {(r["page"], r["end_of_stream"]) for r in read_headers(spark, path).collect()} == {(i, i in (4, 8)) for i in range(9)}
    assert user_ids(landed_pages(spark, spec, path)) == want


def test_missing_page_fails_the_load(spark, tmp_root):
    path = write_pages(tmp_root, "gap", [p for i, p in enumerate(time_pages(6)) if i != 3])
    with pytest.raises(ValueError, match="not landed"):
        full_source(spark, USERS.with_links(), path)


def test_page_without_records_fails(spark, tmp_root):
    pages = time_pages(3)
    pages[1]["users"] = None
    path = write_pages(tmp_root, "hole", pages)
    with pytest.raises(PySparkException, match="without 'users' records"):
        page_source(spark, USERS.with_links(), path).collect()


def test_cursor_pages(spark, tmp_root):
    """Tickets: the next cursor stands alone, the request is a link."""
    pages = [
        {"tickets": [{"id": 1}], "request": f"{HOST}?start_time=0", "after_cursor": "aa==", "end_of_stream": False},
        {"tickets": [{"id": 2}], "request": f"{HOST}?cursor=aa==", "after_cursor": "bb==", "end_of_stream": False},
        {"tickets": [{"id": 3}], "request": f"{HOST}?cursor=bb==", "after_cursor": "cc==", "end_of_stream": True},
    ]
    path = write_pages(tmp_root, "cursors", pages[::-1])
    got = page_source(spark, TICKETS.with_links(), path).select("page", F.col("tickets")[0]["id"].alias("id")).collect()
    assert sorted((r["page"], int(r["id"])) for r in got) == [(0, 1), (1, 2), (2, 3)]


ITEMS = ObjectSpec("items", parse_columns("item_id bigint\nname string"), key="item_id", time_column=None)


@pytest.mark.parametrize("spec", [ITEMS, ITEMS.with_links()])
def test_stop_is_read_from_the_headers(spark, tmp_root, spec):
    """One scan of the pages, and the folders after the stop are not read."""
    items = spark.range(0, 2000).select(F.col("id").alias("item_id"), F.col("id").cast("string").alias("name"))
    path = f"{tmp_root}/blocks"
    land_pages(items, "items", path, F.floor(F.col("item_id") / 10), stop_page=70, headers=True, blocks=True, request_field=spec.request_field)
    records = full_source(spark, spec, path)
    assert records.count() == 710  # pages 0 to 70
    df = records.select("item_id")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    assert len([x for x in plan.splitlines() if "FileScan json" in x]) == 1
    if not spec.request_field:
        # pages 192 on are in a folder of their own: it is not opened
        with open(f"{path}/page_block=3/broken.json", "w") as f:
            f.write("not a page\n")
        assert full_source(spark, spec, path).count() == 710


def test_without_headers_the_pages_are_asked(spark, tmp_root):
    items = spark.range(0, 200).select(F.col("id").alias("item_id"), F.col("id").cast("string").alias("name"))
    path = land_pages(items, "items", f"{tmp_root}/bare", F.floor(F.col("item_id") / 10), stop_page=7)
    assert read_headers(spark, path) is None and full_source(spark, ITEMS, path).count() == 80
    assert store_headers(spark, ITEMS, path).endswith(HEADERS) and full_source(spark, ITEMS, path).count() == 80
