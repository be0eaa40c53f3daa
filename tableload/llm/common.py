"""Shared pieces: table access, white space, word and line columns, id blocks.

White space is ``[\\x20\\x09-\\x0D]`` everywhere, a word is a run of anything
else, and a null text counts as the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableload.session import discard, scratch_dir

#: White space and ASCII letters, as character lists and as a regex class.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_CLASS = r"\x20\x09-\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Any non-ASCII character outside these categories might be changed by a Unicode lower-casing.
_CASED_NON_ASCII = r"[^\x00-\x7F\p{Ll}\p{Lo}\p{M}\p{P}\p{Z}]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark (the path may be in a store only Spark reads)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, f"[{WS_CLASS}]+"), "")


def lines(text: Column) -> Column:
    """The text split at ``\\n``; the empty text is one empty line."""
    return F.split(text, "\n")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else.

    ``lower`` is fast but folds every script; it agrees with the ASCII rule
    unless a cased non-ASCII character occurs, and only then is the slower
    character map used.
    """
    return F.when(F.rlike(text, F.lit(_CASED_NON_ASCII)), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared scratch root and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def save_over(df: DataFrame, name: str, *old: DataFrame) -> DataFrame:
    """``save`` a table that takes the place of ``old`` saved ones, whose folders are deleted once it is written.

    Only for tables that nothing else reads any more: not for one that a DataFrame still to be computed is made of.
    """
    new = save(df, name)
    for table in old:
        discard(df.sparkSession, table.saved_at)
    return new


def long_array(values: list[int]) -> Column:
    """A constant array of longs, folded by the optimizer from one short string literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


#: Id blocks: rows aimed at, and the most blocks (two longs a block reach the driver).
BLOCK_ROWS = 256
MAX_BLOCKS = 65_536


def id_bounds(ids: DataFrame, col: str, block_rows: int = BLOCK_ROWS, max_blocks: int = MAX_BLOCKS) -> list[tuple[int, int]]:
    """(smallest, largest) id of each range block, ascending; equal-depth blocks of about ``block_rows`` rows.

    Only the id column is read and shuffled. At most ``max_blocks`` pairs come
    to the driver; over ``max_blocks * block_rows`` rows the blocks get larger.
    """
    ids = ids.select(F.col(col).cast("long").alias("id")).where("id is not null")
    n = ids.count()
    blocks = max(1, min(max_blocks, -(-n // block_rows)))
    ranged = ids.repartitionByRange(blocks, "id").groupBy(F.spark_partition_id().alias("part"))
    rows = ranged.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).select("lo", "hi").collect()
    return sorted((r.lo, r.hi) for r in rows)


def block_of(id_col: Column, bounds: list[tuple[int, int]]) -> Column:
    """Number of the block an id falls in: a binary search over the blocks' smallest ids; null ids get block 0."""
    n = len(bounds)
    if n <= 1:
        return F.lit(0)
    lows, steps, step = long_array([lo for lo, _ in bounds]), [], 1
    while step < n:
        steps.append(step)
        step *= 2

    def probe(at: Column, by: Column) -> Column:
        return F.when(F.get(lows, at + by) <= id_col, at + by).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in reversed(steps)]), F.lit(0), probe)


#: Key blocks: rows aimed at, the most blocks, and the accuracy of their bounds.
KEY_BLOCK_ROWS, MAX_KEY_BLOCKS, BOUND_ACCURACY = 8_192, 2_048, 20_000


def key_blocks(rows: DataFrame, col: str) -> tuple[Column, Column]:
    """(block number, crowded) of a whole-number key: equal-depth ranges in key order, null in block -1.

    The bounds come from one percentile aggregate (at most MAX_KEY_BLOCKS
    numbers reach the driver); a block holds about KEY_BLOCK_ROWS rows, or a
    2,048th of a larger table. A key that fills a block alone gets one of its own and
    is crowded, as null is: its rows need another key to be split by.
    """
    key = F.col(col).cast("long")
    n = rows.select(F.count(key)).first()[0]
    blocks = max(1, min(MAX_KEY_BLOCKS, -(-n // KEY_BLOCK_ROWS)))
    if not n or blocks == 1:
        return F.when(key.isNull(), -1).otherwise(0), key.isNull()
    at = rows.agg(F.percentile_approx(key, [i / blocks for i in range(1, blocks)], BOUND_ACCURACY)).first()[0]
    crowded = {a for a, b in zip(at, at[1:]) if a == b}
    lows = sorted(set(at) | crowded | {k + 1 for k in crowded})
    bounds = [(lo, lo) for lo in [-(1 << 63), *lows]]
    alone = F.array_contains(long_array(sorted(crowded)), key) if crowded else F.lit(False)
    return F.when(key.isNull(), -1).otherwise(block_of(key, bounds)), F.coalesce(alone, F.lit(True))
