"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableload.llm.common import save, save_over


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, label) of every end of an edge (a, b): label is the smallest id of its component.

    Each round points every vertex to its smallest neighbour (or itself),
    follows the pointers to their roots by doubling, and renames labels and
    edges by root. Every tree has at least two vertices, so the vertices that
    still have edges at least halve a round. A hub's edges are reduced map-side
    before its minimum is shuffled. The tables of a round are written to the
    scratch folder, and those of the round before are deleted.
    """
    edges = save(edges.select("a", "b").where("a <> b").distinct(), "edges")
    ends = edges.select(F.col("a").alias("doc_id")).union(edges.select(F.col("b").alias("doc_id"))).distinct()
    labels = save(ends.withColumn("label", F.col("doc_id")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        moves = both.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("to")).withColumn("to", F.least("at", "to"))
        moves = save(moves, "moves")
        while True:
            far = moves.join(moves.select(F.col("at").alias("to"), F.col("to").alias("next")), "to").select("at", "to", "next")
            if far.where("next <> to").isEmpty():
                break
            moves = save_over(far.select("at", F.col("next").alias("to")), "moves", moves)
        renamed = labels.join(moves, F.col("label") == F.col("at"), "left").select("doc_id", F.coalesce("to", "label").alias("label"))
        labels = save_over(renamed, "labels", labels)
        met = edges.join(moves, F.col("a") == F.col("at")).select(F.col("to").alias("a"), "b")
        met = met.join(moves, F.col("b") == F.col("at")).select("a", F.col("to").alias("b"))
        edges = save_over(met.where("a <> b").distinct(), "edges", edges, moves)
    return labels
