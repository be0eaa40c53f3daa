"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line stripped of white space at both ends with A-Z
lower-cased; keys shorter than ``MIN_CHARS`` code points are never dropped.
The index holds, for each key hash (96 bits), in how many documents it was
found and the largest doc_id holding it. It is a set of runs, each a Parquet
folder sorted by hash, in levels: a batch of documents is merge-anti-joined
with the runs' settled keys (already in ``MIN_DOCS`` documents), and what is
left becomes a run of level 0; ``FANOUT`` runs of a level are merged into one
run of the next. Batches come in descending doc_id, so a settled key's largest
doc_id is known when it is settled and later batches need not add it again.

A key found in at least ``MIN_DOCS`` documents then loses its lines everywhere
but in its largest doc_id (where all its lines stay).

Only DataFrame functions are used. Texts are read twice: to hash their lines to a
narrow table, from which the batches are cut and the dropped lines found, and
to be shuffled once, to meet the positions of the lines they lose. A hot
line is one row after the map-side aggregate; the join of occurrences with
settled keys is an inner sort-merge join that AQE can split.

Cases: null or empty text is one empty line and stays; repeated rows (same
doc_id) count as one document; rows with a null doc_id neither count nor lose
lines; an empty table gives an empty result; other columns are kept by
``dedup_lines`` and ignored by the report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableload.llm.common import WS_CHARS, ascii_lower, lines, save, text_of
from tableload.session import scratch_dir

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2


def line_key(line: Column) -> Column:
    """The line's key: stripped, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WS_CHARS)))


def line_hashes(docs: DataFrame, *keep: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """``keep`` columns, pos (0-based) and the key hash (h1 long, h2 int) of every line long enough."""
    one = docs.select(*keep, F.posexplode(lines(text_of())).alias("pos", "line"))
    one = one.select(*keep, "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return one.select(*keep, "pos", F.xxhash64("key").alias("h1"), F.hash("key", F.lit(1)).alias("h2"))


class LineRuns:
    """The levelled index: (h1, h2, n, last) rows in sorted runs under one scratch folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, min_docs: int = MIN_DOCS):
        self.spark, self.fanout, self.min_docs = spark, fanout, min_docs
        self.root = scratch_dir(spark, "line-runs")
        self.levels: list[list[str]] = [[]]
        self.written = 0

    SCHEMA = "h1 long, h2 int, n long, last long"

    def _write(self, entries: DataFrame, level: int) -> None:
        """One run: hash-partitioned (by the aggregate or join before) and sorted within each file."""
        path = f"{self.root}/{self.written:04d}-level{level}"
        self.written += 1
        entries.select("h1", "h2", "n", "last").sortWithinPartitions("h1", "h2").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            paths, self.levels[level] = self.levels[level], []
            self._write(self._merged(paths), level + 1)

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(*paths)

    def _merged(self, paths: list[str]) -> DataFrame:
        """Entries of several runs, one row a key."""
        return self._read(paths).groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    def paths(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def add(self, hashes: DataFrame) -> None:
        """Merge-anti-join one batch's keys with the settled keys of the runs and add the rest as a run."""
        found = hashes.where("doc_id is not null").select("h1", "h2", "doc_id").distinct()
        entries = found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
        if self.paths():
            settled = self._read(self.paths()).where(F.col("n") >= self.min_docs).select("h1", "h2").hint("merge")
            entries = entries.join(settled, ["h1", "h2"], "left_anti")
        self._write(entries, 0)

    def settled(self) -> DataFrame:
        """(h1, h2, last) of the keys found in at least ``min_docs`` documents."""
        return self._merged(self.paths()).where(F.col("n") >= self.min_docs).select("h1", "h2", "last")


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_hash, pos, h1, h2) of every line that can be dropped, written to the scratch folder."""
    rows = docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64(text_of()).alias("text_hash"))
    return save(line_hashes(rows, "doc_id", "text_hash", min_chars=min_chars), "line-hashes")


def index_lines(hashes: DataFrame, batches: int = BATCHES, min_docs: int = MIN_DOCS) -> LineRuns:
    """The index of a whole table's line hashes, taken in ``batches`` doc_id ranges from the largest ids down."""
    runs = LineRuns(hashes.sparkSession, min_docs=min_docs)
    doc_id = F.col("doc_id").cast("long")
    low, at = hashes.agg(F.min(doc_id), F.percentile_approx(doc_id, [i / batches for i in range(1, batches)])).first()
    lows = [] if low is None else sorted({low, *(at or [])})
    for k in reversed(range(len(lows))):
        part = doc_id >= lows[k]
        if k + 1 < len(lows):
            part = part & (doc_id < lows[k + 1])
        runs.add(hashes.where(part))
    return runs


def dropped_lines(hashes: DataFrame, runs: LineRuns) -> DataFrame:
    """(doc_id, text_hash, drops): positions of the lines each document loses; documents that lose none are absent."""
    lost = hashes.join(runs.settled(), ["h1", "h2"]).where("doc_id <> last")
    return lost.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("drops"))


def with_kept_text(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of ``docs`` plus __kept (text left), __n_lines and __n_dropped."""
    hashes = hashed_lines(docs.select("doc_id", "text"), min_chars)
    runs = index_lines(hashes, batches, min_docs)
    if not runs.paths():  # no row has a doc_id and a line long enough
        return docs.withColumns({"__kept": text_of(), "__n_lines": F.size(lines(text_of())).cast("long"), "__n_dropped": F.lit(0).cast("long")})
    drops = dropped_lines(hashes, runs).withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash", "drops": "__drops"})
    df = docs.join(drops, (F.col("doc_id") == F.col("__id")) & (F.xxhash64(text_of()) == F.col("__hash")), "left")
    df = df.withColumn("__lines", lines(text_of()))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__drops")
    kept = F.array_join(F.transform(left, lambda i: F.get("__lines", i)), "\n")
    return df.withColumns(
        {
            "__kept": F.when(F.col("__drops").isNull(), text_of()).otherwise(kept),
            "__n_lines": F.size("__lines").cast("long"),
            "__n_dropped": F.when(F.col("__drops").isNull(), 0).otherwise(F.size("__drops")).cast("long"),
        }
    ).drop("__lines", "__drops", "__id", "__hash")


def dedup_lines(docs: DataFrame, **settings: int) -> DataFrame:
    """The documents with their repeated lines dropped: ``text`` is what is left, other columns stay."""
    columns = docs.columns
    df = with_kept_text(docs, **settings)
    return df.select(*[F.col("__kept").alias(c) if c == "text" else F.col(f"`{c}`") for c in columns])


def line_report(docs: DataFrame, **settings: int) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 (of the UTF-8 text left) per document."""
    df = with_kept_text(docs.select("doc_id", "text"), **settings)
    return df.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(F.col("__kept").cast("binary"), 256).alias("kept_sha256"))
