"""WARC fixity audit over Merkle trees of two replicas.

A record is known by its file and key, its offset and length, and the SHA-256 of
its bytes. Each file has a tree over ordered offset ranges: a leaf range of ``RANGE_BYTES``
hashes the records that begin in it, in order, and each level above hashes ``FAN``
neighbouring ranges, in order, with their range numbers, until one range holds
the file. File roots are hashed into ``BUCKETS`` groups of files and these into the
replica's root.

Two replicas are compared from the root down: groups of files, files, then one
level of ranges after the other, each time only the children of nodes that
differ, and at last the records of the leaf ranges that differ. A sound replica
costs the comparison of one row. A record lost or grown in mid-file moves all
after it, so their ranges differ too; the records in them are therefore aligned by key, and
one that only moved is sound.

Record bytes are hashed where they are read. Rows that agree in file, key and bytes
are one row with a count. Offsets come from sums by (file, block of keys) first, and the
order within such a block (``common.key_blocks``; a frequent key and null are split further by digest), so
neither a large file nor a frequent key gathers in one task. In the ranges an empty
record counts as one byte, so every group that is hashed together is bounded (a leaf range, ``FAN``
children), however many empty records there are.

Cases: a null payload is an empty record; null is a file like others; a record
missing from the replica is "lost", one only there "extra", one whose key has other
bytes or another length "corrupt"; rows that repeat a key are compared as a
multiset of their bytes, and what differs is "corrupt" where it is one for one, else "lost" and "extra" one by one, as it
is for null keys, which name no record; of copies alike the last ones are named;
two empty replicas are equal; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableload.llm.common import key_blocks, save

RANGE_BYTES = 1 << 16
FAN = 16
BUCKETS = 256


def warc_record(kind: str, uri: Column, record_id: Column, body: Column) -> Column:
    """Bytes of a WARC/1.0 record: header lines, an empty line, the body and two line ends."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:record:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(uri, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def record_digests(records: DataFrame, file: str, order: str, payload: str) -> DataFrame:
    """(file, key, length, digest, copies, offset, pos): records laid one after the other in ``order`` (whole numbers) within each file.

    The payload is hashed before anything is shuffled. ``pos`` is the offset with empty records counted as a byte.
    """
    body = F.coalesce(F.col(payload), F.lit(b""))
    rows = records.select(F.col(file).alias("file"), F.col(order).cast("long").alias("key"), F.octet_length(body).cast("long").alias("length"), F.sha2(body, 256).alias("digest"))
    rows = save(rows.groupBy("file", "key", "length", "digest").agg(F.count("*").alias("copies")), "merkle-records")
    block, crowded = key_blocks(rows, "key")
    part = F.when(crowded, F.substring("digest", 1, 3)).otherwise("")
    rows = rows.withColumn("block", block).withColumn("part", part)
    sizes = [F.col("length") * F.col("copies"), F.greatest(F.col("length"), F.lit(1)) * F.col("copies")]

    def running(by: list[str], order: list[str], of: list[Column], names: list[str]) -> list[Column]:
        before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(x).over(before), F.lit(0)).alias(n) for x, n in zip(of, names, strict=True)]

    totals = rows.groupBy("file", "block", "part").agg(F.sum(sizes[0]).alias("bytes"), F.sum(sizes[1]).alias("room"))
    starts = totals.select("file", "block", "part", *running(["file"], ["block", "part"], [F.col("bytes"), F.col("room")], ["at", "pos_at"]))
    within = rows.select("*", *running(["file", "block", "part"], ["key", "digest", "length"], sizes, ["offset", "pos"]))
    starts = starts.withColumnsRenamed({"file": "f", "block": "b", "part": "p"})
    on = F.col("file").eqNullSafe(F.col("f")) & (F.col("block") == F.col("b")) & (F.col("part") == F.col("p"))
    return within.join(starts, on).select("file", "key", "length", "digest", "copies", (F.col("offset") + F.col("at")).alias("offset"), (F.col("pos") + F.col("pos_at")).alias("pos"))


def _node(*parts: Column) -> Column:
    """Digest of ordered children: a group's structs, sorted, as one string."""
    return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*parts))), lambda x: F.to_json(x)), "\n"), 256)


class Tree:
    """The levels of one replica: ``levels[0]`` leaf ranges ... the last has one range a file; then ``files``, ``buckets``."""

    def __init__(self, records: DataFrame, levels: int, name: str):
        self.records = records
        nodes = records.groupBy("file", F.floor(F.col("pos") / RANGE_BYTES).alias("range"))
        level = save(nodes.agg(_node(*[F.col(x) for x in ("pos", "offset", "key", "length", "digest", "copies")]).alias("digest")), f"merkle-{name}-0")
        self.levels = [level]
        for k in range(1, levels):
            nodes = level.groupBy("file", F.floor(F.col("range") / FAN).alias("up"))
            level = nodes.agg(_node(F.col("range"), F.col("digest")).alias("digest")).withColumnRenamed("up", "range")
            level = save(level, f"merkle-{name}-{k}")
            self.levels.append(level)
        self.files = level.select("file", "digest").withColumn("bucket", F.pmod(F.xxhash64("file"), F.lit(BUCKETS)))
        self.buckets = save(self.files.groupBy("bucket").agg(_node(F.col("file"), F.col("digest")).alias("digest")), f"merkle-{name}-buckets")
        self.root = self.buckets.agg(_node(F.col("bucket"), F.col("digest")).alias("digest")).first()["digest"]


def levels_for(*replicas: DataFrame) -> int:
    """Levels until one range holds the longest file."""
    longest = max([0, *[(r.agg(F.max("pos")).first()[0] or 0) for r in replicas]])
    ranges, levels = longest // RANGE_BYTES + 1, 1
    while ranges > 1:
        ranges, levels = -(-ranges // FAN), levels + 1
    return levels


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests differ or that only one side has."""
    a, b = a.select(*keys, F.col("digest").alias("da")), b.select(*keys, F.col("digest").alias("db"))
    return a.join(b, keys, "full_outer").where(~F.col("da").eqNullSafe(F.col("db"))).select(*keys)


def _known(x: str) -> Column:
    """A value as text that is never null, so that null joins with null."""
    return F.to_json(F.struct(F.col(x).alias("is")))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """(file, offset, status, key, length, expected, found): records of ``first`` that ``second`` lost or holds corrupt, and extra ones.

    Both are as ``record_digests`` gives them.
    """
    sides = [save(r.withColumnRenamed("file", "name").withColumn("file", _known("name")), f"merkle-{x}") for r, x in ((first, "a"), (second, "b"))]
    levels = levels_for(*sides)
    a, b = Tree(sides[0], levels, "a"), Tree(sides[1], levels, "b")
    if a.root == b.root:
        found = a.files.limit(0).select("file", F.lit(0).cast("long").alias("range"))
    else:
        buckets = _differing(a.buckets, b.buckets, ["bucket"])
        in_buckets = [t.files.join(buckets, "bucket", "left_semi") for t in (a, b)]
        files = _differing(*in_buckets, ["file"])
        found = save(files.withColumn("range", F.lit(0).cast("long")), "merkle-files")
        for k in reversed(range(levels - 1)):
            up = F.floor(F.col("range") / FAN)
            below = [t.levels[k].withColumn("up", up).join(found.withColumnRenamed("range", "up"), ["file", "up"], "left_semi") for t in (a, b)]
            found = save(_differing(*below, ["file", "range"]), f"merkle-differing-{k}")
    return _aligned(*[r.withColumn("range", F.floor(F.col("pos") / RANGE_BYTES)).join(found, ["file", "range"], "left_semi") for r in sides])


def _aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    """The damage among the records of differing ranges, by key."""
    same = ["file", "of", "length", "digest"]
    kept = [r.withColumn("of", _known("key")).select(*same, F.struct("name", "key", "length", "digest", "copies", "offset").alias(x)) for r, x in ((left, "a"), (right, "b"))]
    more = F.coalesce("a.copies", F.lit(0)) - F.coalesce("b.copies", F.lit(0))
    groups = kept[0].join(kept[1], same, "full_outer").withColumn("more", more).where("more <> 0")
    groups = save(groups.select("file", "of", F.when(F.col("more") > 0, F.col("a")).otherwise(F.col("b")).alias("rec"), "more"), "merkle-damage")

    lost, extra = F.col("more") > 0, F.col("more") < 0
    per_key = groups.groupBy("file", "of").agg(
        F.sum(F.when(lost, F.col("more")).otherwise(0)).alias("n_lost"),
        F.sum(F.when(extra, -F.col("more")).otherwise(0)).alias("n_extra"),
        F.max(F.when(lost, F.col("rec"))).alias("a"),
        F.max(F.when(extra, F.col("rec"))).alias("b"),
    )
    pairs = per_key.where("n_lost = 1 and n_extra = 1 and a.key is not null")

    def last_copy(rec: str) -> Column:
        return F.col(f"{rec}.offset") + F.col(f"{rec}.length") * (F.col(f"{rec}.copies") - 1)

    corrupt = pairs.select(F.col("a.name").alias("file"), last_copy("a").alias("offset"), F.lit("corrupt").alias("status"), "a.key", "a.length", F.col("a.digest").alias("expected"), F.col("b.digest").alias("found"))
    single = groups.join(pairs, ["file", "of"], "left_anti").withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("more"))))
    alone = single.select(
        F.col("rec.name").alias("file"),
        (F.col("rec.offset") + F.col("rec.length") * (F.col("rec.copies") - F.col("nth"))).alias("offset"),
        F.when(lost, "lost").otherwise("extra").alias("status"),
        "rec.key",
        "rec.length",
        F.when(lost, F.col("rec.digest")).alias("expected"),
        F.when(extra, F.col("rec.digest")).alias("found"),
    )
    return corrupt.union(alone)
