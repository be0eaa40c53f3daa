"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in doc_id order, form blocks of ``BLOCK_DOCS``. With
weight w, its block j (from 0) is released at slot floor(j / w) and due by slot
ceil((j + 1) / w). Every slot takes, of the released blocks, the one due first
(earliest deadline first), so after any number of slots t a source has had w * t
blocks to within less than one block.

Weights are whole parts of their sum ``total``, so the schedule repeats every
``total`` slots; the bound of one block is against these weights. Given parts are taken as they
are. Those of ``source_parts`` are real weights in parts of about ``TOTAL``, or
``PARTS_A_SOURCE`` for every source where that is more, so that the part which every
source gets at least takes little from the others however many there are. One period is worked out by a fold over its slots; it depends
on the weights alone. A block then finds its slot from its number: block j of a
source with p parts is block j mod p of period j div p. No pass over the blocks
in order is needed.

Nothing is dropped or repeated: a source that has run out leaves its slots
empty, and the others keep their places, so each of them still has had its
share of all slots. A reader that wants the exact mix stops at the first empty
slot; one that wants every document skips them.

Only DataFrame functions are used. Documents are numbered through equal-depth
id blocks (counts before a block, then rows within it), so a source with a
third of all rows is not ordered in one task. The fold costs sources x total
steps; the sources are those of the weights, a parameter.

Cases: a null source counts as the empty one; rows with a null doc_id come
first in their source; repeated rows each get a place; an empty table gives an
empty result; other columns are kept by ``mix_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableload.llm.common import key_blocks, save

BLOCK_DOCS = 16
#: Parts that real weights are rounded to (every source gets at least one): in all, and for each source where that is more.
TOTAL, PARTS_A_SOURCE = 512, 16
#: A source's weight goes with its number of documents to this power.
ALPHA = 0.7


def source_parts(docs: DataFrame, total: int = TOTAL, alpha: float = ALPHA) -> DataFrame:
    """(source, parts): tempered weights over all documents, in whole parts of about ``total`` or more."""
    sizes = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.pow(F.count(F.lit(1)), F.lit(alpha)).alias("w"))
    # one row a source: shares are rounded where they add up, so that they fill the total
    order = Window.orderBy("source")
    upto = F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    n = F.count(F.lit(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    sizes = sizes.withColumn("end", F.round(upto * F.greatest(F.lit(total), n * PARTS_A_SOURCE)))
    return sizes.select("source", F.greatest(F.lit(1), F.col("end") - F.coalesce(F.lag("end").over(order), F.lit(0))).cast("long").alias("parts"))


def period(parts: DataFrame) -> DataFrame:
    """(source, nth, at, parts, total): the slot ``at`` of every source's nth block within one period."""
    one = parts.agg(F.sort_array(F.collect_list(F.struct("source", "parts"))).alias("s"))
    one = one.withColumn("total", F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["parts"]))

    def step(state: Column, slot: Column) -> Column:
        def urgency(x: Column, i: Column) -> Column:
            had = F.get(state["had"], i)
            released = F.floor(had * F.col("total") / x["parts"]) <= slot
            due = F.ceil((had + 1) * F.col("total") / x["parts"])
            return F.when(released, F.struct(due.alias("due"), i.alias("i")))

        chosen = F.array_min(F.transform("s", urgency))["i"]
        had = F.transform(state["had"], lambda h, i: h + (i == chosen).cast("long"))
        return F.struct(had.alias("had"), F.concat(state["order"], F.array(chosen)).alias("order"))

    start = F.struct(F.transform("s", lambda x: F.lit(0).cast("long")).alias("had"), F.array().cast("array<int>").alias("order"))
    slots = F.sequence(F.lit(0).cast("long"), F.col("total") - 1)
    one = one.where("total > 0").withColumn("order", F.aggregate(slots, start, step)["order"])
    each = one.select("s", "total", F.posexplode("order").alias("at", "i")).select(F.get("s", F.col("i")).alias("s"), "total", "at")
    nth = F.row_number().over(Window.partitionBy("s.source").orderBy("at")) - 1
    return each.select("s.source", nth.cast("long").alias("nth"), F.col("at").cast("long").alias("at"), "s.parts", "total")


def with_slots(docs: DataFrame, parts: DataFrame | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """All columns plus __source, __block (number within the source), __slot and __place (within the block).

    The rows are shuffled once, by source and id block.
    """
    turns = save(period(parts if parts is not None else source_parts(docs)), "mix-period")
    chunk, _ = key_blocks(docs, "doc_id")
    df = docs.withColumns({"__source": F.coalesce("source", F.lit("")), "__chunk": chunk})
    sizes = df.groupBy("__source", "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__source").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__source", "__chunk", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    df = df.join(save(sizes, "mix-offsets").hint("merge"), ["__source", "__chunk"])
    row = F.row_number().over(Window.partitionBy("__source", "__chunk").orderBy("doc_id"))
    df = df.withColumn("__at", F.col("__before") + row - 1).drop("__before", "__chunk")
    df = df.withColumns({"__block": F.floor(F.col("__at") / block_docs), "__place": (F.col("__at") % block_docs).cast("int")}).drop("__at")
    turns = turns.select(F.col("source").alias("__s"), F.col("nth").alias("__nth"), F.col("at").alias("__t"), F.col("parts").alias("__p"), F.col("total").alias("__total"))
    parts_of = turns.groupBy("__s").agg(F.first("__p").alias("__parts"))
    df = df.join(save(parts_of, "mix-parts").withColumnRenamed("__s", "__source"), "__source")
    df = df.withColumn("__turn", F.col("__block") % F.col("__parts"))
    df = df.join(turns, (F.col("__source") == F.col("__s")) & (F.col("__turn") == F.col("__nth")))
    slot = F.floor(F.col("__block") / F.col("__parts")) * F.col("__total") + F.col("__t")
    return df.withColumn("__slot", slot).drop("__s", "__nth", "__t", "__p", "__total", "__parts", "__turn")


def mix_schedule(docs: DataFrame, parts: DataFrame | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """doc_id, source, block, slot and place of every document."""
    df = with_slots(docs.select("doc_id", "source"), parts, block_docs)
    return df.select("doc_id", F.col("__source").alias("source"), F.col("__block").alias("block"), F.col("__slot").alias("slot"), F.col("__place").alias("place"))


def mix_documents(docs: DataFrame, parts: DataFrame | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The documents in mixed order (by slot, then place), all columns as they were."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return with_slots(docs, parts, block_docs).orderBy("__slot", "__place").select(*columns)
