"""Pages in the order of their links, for landings that give no page numbers.

Every page names the link (or cursor) it answers and the one that follows it, as a
list whose cells lie scattered. ``order_links`` ranks it by pointer doubling:
each page points to its successor, and in every round to its pointer's pointer,
adding up the steps, so a list of n pages takes about log2(n) joins. Pointers stay
one to one, so no key of such a join is hot, and only keys and counts move,
never the records. Each round is written to the scratch folder (a lost executor
reads it again) and the one before it is deleted.

Cases: a page may arrive as several documents that agree in both links; a first
request without a link is the empty key; the last page's own successor has not
been fetched yet, may be itself, and is not looked for. A page whose successor
is missing, two pages with one successor, one page with two, several lists, and a
circle fail the load, since their order (and where the stream ends) is not known.
No pages give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import link_param
from ..session import discard, materialise

#: How many offending links an error names.
SHOWN = 5


def link_key(link: Column) -> Column:
    """What a link asks for: its cursor (also when it stands alone), else its start time, else the link; no link is the empty key."""
    start = F.concat(F.lit("start_time="), link_param(link, "start_time"))
    return F.coalesce(link_param(link, "cursor"), start, link, F.lit(""))


def _fail(rows: DataFrame, said: str) -> None:
    found = [r[0] for r in rows.limit(SHOWN).collect()]
    if found:
        raise ValueError(f"{said}: {found}")


def order_links(links: DataFrame) -> DataFrame:
    """(own, page) from (own, next, ended): each page's place, from 0, by following the links."""
    spark = links.sparkSession
    merged = links.groupBy("own").agg(
        F.min("next").alias("next"),
        F.max("next").alias("other"),
        (F.count("next") % F.count(F.lit(1)) != 0).alias("partly"),
        F.max(F.coalesce("ended", F.lit(False))).alias("ended"),
    )
    nodes, at_nodes = materialise(merged, "page-links")
    _fail(nodes.where(F.col("partly") | (F.col("next") != F.col("other"))).select("own"), "pages with several next links")

    landed = nodes.select(F.col("own").alias("next"), F.lit(True).alias("landed"))
    joined = nodes.join(landed, "next", "left").withColumn("landed", F.coalesce("landed", F.lit(False)))
    last = F.col("next").isNull() | (F.col("ended") & (~F.col("landed") | (F.col("next") == F.col("own"))))
    first = joined.select("own", F.when(~last, F.col("next")).alias("at"), (~last).cast("long").alias("hops"), "landed")
    state, at_state = materialise(first, "page-ranks")
    discard(spark, at_nodes)
    _fail(state.where("at is not null and not landed").select("at"), "next pages that were not landed")
    _fail(state.where("at is not null").groupBy("at").count().where("count > 1").select("at"), "next links that several pages carry")
    n, ends = state.agg(F.count("*"), F.count_if(F.col("at").isNull())).first()
    if n and ends != 1:
        raise ValueError("the page links run in a circle" if not ends else f"the page links make {ends} lists, not one")

    state = state.select("own", "at", "hops")
    for _ in range(n.bit_length() + 1):
        on = state.where("at is not null")
        if on.isEmpty():
            return state.select("own", (F.lit(n - 1) - F.col("hops")).alias("page"))
        far = state.select(F.col("own").alias("at"), F.col("at").alias("to"), F.col("hops").alias("more"))
        moved = on.join(far, "at").select("own", F.col("to").alias("at"), (F.col("hops") + F.col("more")).alias("hops"))
        before = at_state
        state, at_state = materialise(moved.unionByName(state.where("at is null")), "page-ranks")
        discard(spark, before)
    if n:
        raise ValueError("the page links run in a circle")
    return state.select("own", F.col("hops").alias("page"))
