"""``merge_upsert``: update matched rows, insert unmatched ones, by key.

Semantics (standard SQL ``MERGE`` with a plain ``=`` match):

* a target row whose key equals a day row's key takes **every** column from
  the day row, nulls included (never ``coalesce``);
* duplicate keys in the target stay separate rows, each updated;
* null keys never match: null-key target rows stay, null-key day rows are
  inserted;
* a non-null key twice in the day is an error (the match would be ambiguous).

Plan (one for every size of the day; Spark's own size check picks the joins):

1. ``upd``  = target LEFT JOIN day on key, ``when(matched, day.c).otherwise(t.c)``.
   With a small day the join is a broadcast hash join and the target streams
   through untouched; a big day is sort-merged. Keys (null too) that hold more
   than a task's share of the target are found by a sketch of the key column
   (``hot_keys``) and salted: their target rows are dealt over as many tasks
   as their share is worth, and their one day row goes to each of these.
2. ``hit``  = target keys LEFT SEMI day keys. Reads only the key column; a Bloom
   filter of the day's keys (``key_filter``) drops target keys before anything
   moves, and the rest are made distinct map-side. So what crosses the network is
   at most one row per day key per task, plus the filter's few errors.
3. ``ins``  = day LEFT ANTI hit.
4. ``upd UNION ALL ins``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import c, q

_MATCH = "__tl_matched"
_SALT = "__tl_salt"
#: Keys that may be salted, items the sketch tracks (its error is about 3.5 / TRACKED of all rows),
#: and rows from which on a key is worth a task of its own.
HOT_KEYS, TRACKED, HOT_ROWS = 256, 16_384, 10_000
#: Bloom filter: bits a key, bits set for each, and the most 64-bit words (8 MiB; more keys make more errors, not more bytes).
KEY_BITS, KEY_PROBES, MAX_WORDS = 16, 4, 1 << 20
#: Key types whose equality is that of their bytes, so that a hash can stand for them.
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def hot_keys(rows: DataFrame, key: str, parts: int | None = None, least: int = HOT_ROWS) -> dict:
    """Keys with more than one of ``parts`` shares of the rows -> how many tasks they are dealt over.

    One pass over the key column: a frequent-items sketch, merged from the
    tasks' own; at most HOT_KEYS keys come to the driver. Null is a key here:
    it never matches, but its rows are shuffled with the others.
    """
    if parts is None:
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not isinstance(rows.schema[key].dataType, (*_EXACT, T.DecimalType, T.StringType)):
        return {}
    top, n = rows.agg(F.expr(f"approx_top_k({q(key)}, {HOT_KEYS}, {TRACKED})"), F.count(F.lit(1))).first()
    share = max(n / parts, least)
    return {r["item"]: min(parts, -(-r["count"] * parts // n)) for r in top or [] if r["count"] > share}


def _pieces(key: Column, hot: dict) -> Column:
    """How many tasks a key's rows are dealt over."""
    known = [F.lit(x) for pair in hot.items() if pair[0] is not None for x in pair]
    of_key = F.coalesce(F.try_element_at(F.create_map(*known), key), F.lit(1)) if known else F.lit(1)
    return F.when(key.isNull(), F.lit(hot.get(None, 1))).otherwise(of_key).cast("long")


def salt_rows(rows: DataFrame, key: str, hot: dict) -> DataFrame:
    """Many rows a key: each with the number of the task its key's rows are dealt to."""
    return rows.withColumn(_SALT, F.pmod(F.monotonically_increasing_id(), _pieces(c(key), hot)))


def salt_keys(rows: DataFrame, key: str, hot: dict) -> DataFrame:
    """One row a key: a copy for every task that the key's rows are dealt to."""
    return rows.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), _pieces(c(key), hot) - 1)))


def key_filter(day: DataFrame, key: str, day_rows: int) -> Callable[[Column], Column]:
    """A test that every key of the day passes, and of other keys about one in two hundred.

    A Bloom filter whose bits for one key lie in one 64-bit word. The words are
    aggregated from the day's key column (map-side first) and reach the
    scan as a scalar subquery of at most MAX_WORDS words, so the test is a
    built-in expression within the scan's stage.
    """
    words = min(MAX_WORDS, 1 << max(6, (day_rows * KEY_BITS // 64).bit_length()))

    def place(k: Column) -> Column:
        return F.pmod(F.shiftrightunsigned(F.xxhash64(k), 24), F.lit(words)).cast("int")

    def mask(k: Column) -> Column:
        h, out = F.xxhash64(k), F.lit(0).cast("long")
        for i in range(KEY_PROBES):
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(63).cast("int"))
            out = out.bitwiseOR(bit)
        return out

    k = c(key)
    bits = day.where(k.isNotNull()).select(place(k).alias("at"), mask(k).alias("bits"))
    none = day.sparkSession.range(words).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("bits"))
    whole = bits.unionByName(none).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    table = whole.agg(F.sort_array(F.collect_list(F.struct("at", "bits"))).alias("t")).select(F.col("t.bits")).scalar()
    return lambda k: F.get(table, place(k)).bitwiseAND(mask(k)) == mask(k)


def day_key_test(target: DataFrame, day: DataFrame, key: str, day_rows: int | None) -> Callable[[Column], Column] | None:
    """``key_filter`` where both keys are of one type that hashes as it compares, else None."""
    kinds = target.schema[key].dataType, day.schema[key].dataType
    if kinds[0] != kinds[1] or not (isinstance(kinds[0], (*_EXACT, T.DecimalType)) or kinds[0] == T.StringType()):
        return None
    return key_filter(day, key, day.count() if day_rows is None else day_rows)


def _day_columns(day: DataFrame, cols: list[str]) -> DataFrame:
    """Day rows with positional private names, so no name can clash with the target's."""
    missing = [n for n in cols if n not in day.columns]
    if missing:
        raise ValueError(f"day rows lack target columns: {missing}")
    return day.select(*[c(n).alias(f"__tl_d{i}") for i, n in enumerate(cols)])


def duplicate_keys(day: DataFrame, key: str, limit: int = 20) -> list:
    """Non-null keys that occur more than once in the day (at most ``limit`` shown)."""
    dups = day.where(c(key).isNotNull()).groupBy(c(key).alias("k")).count().where(F.col("count") > 1)
    return [r["k"] for r in dups.select("k").limit(limit).collect()]


def assert_unique_keys(day: DataFrame, key: str) -> None:
    dups = duplicate_keys(day, key)
    if dups:
        raise ValueError(f"duplicate {key} in the day's rows: {dups}")


def merge_match(target: DataFrame, day: DataFrame, key: str, hot: dict | None = None) -> DataFrame:
    """The pairs the merge updates: each target row with the day row of its key.

    Plain ``=``, so null keys never pair. Columns: struct ``target`` and struct
    ``day``, each with the rows' own column names. An inner join; Spark
    broadcasts a small day by its own size check, else sort-merges, with the
    target's hot keys salted.
    """
    hot = {k: n for k, n in (hot_keys(target, key) if hot is None else hot).items() if k is not None}
    t = target.select(F.struct(*[c(n) for n in target.columns]).alias("target"), c(key).alias("__tl_tk"))
    d = day.select(F.struct(*[c(n) for n in day.columns]).alias("day"), c(key).alias("__tl_dk"))
    on = F.col("__tl_tk") == F.col("__tl_dk")
    if hot:
        t, d = salt_rows(t, "__tl_tk", hot), salt_keys(d, "__tl_dk", hot).withColumnRenamed(_SALT, "__tl_piece")
        on = on & (F.col(_SALT) == F.col("__tl_piece"))
    return t.join(d, on, "inner").select("target", "day")


def merge_update_matched(target: DataFrame, day: DataFrame, key: str, hot: dict | None = None) -> DataFrame:
    """Every target row; matched ones carry the day row's values.

    ``hot`` are the target's hot keys, found here when not given; without any
    the join is a plain one (and keeps a bucketed target's partitioning).
    """
    hot = hot_keys(target, key) if hot is None else hot
    cols = target.columns
    dk = f"__tl_d{cols.index(key)}"
    d = _day_columns(day, cols).withColumn(_MATCH, F.lit(True))
    t, on = target, c(key) == F.col(dk)
    if hot:
        t, d = salt_rows(target, key, hot), salt_keys(d, dk, hot).withColumnRenamed(_SALT, "__tl_piece")
        on = on & (F.col(_SALT) == F.col("__tl_piece"))
    joined = t.join(d, on, "left")
    return joined.select(
        *[F.when(F.col(_MATCH), F.col(f"__tl_d{i}")).otherwise(c(n)).alias(n) for i, n in enumerate(cols)]
    )


def matched_keys(target: DataFrame, day: DataFrame, key: str, day_rows: int | None = None) -> DataFrame:
    """Distinct day keys that exist in the target (one column ``__tl_k``).

    Target keys that the day's filter rejects stay where they are, the others are made distinct before they move.
    """
    test = day_key_test(target, day, key, day_rows)
    t_keys = target.select(c(key).alias("__tl_k")).where(F.col("__tl_k").isNotNull())
    if test:
        t_keys = t_keys.where(test(F.col("__tl_k")))
    d_keys = day.select(c(key).alias("__tl_k"))
    return t_keys.distinct().join(d_keys, "__tl_k", "left_semi")


def merge_insert_unmatched(target: DataFrame, day: DataFrame, key: str, day_rows: int | None = None) -> DataFrame:
    """Day rows whose key has no match in the target (null keys included)."""
    cols = target.columns
    hit = matched_keys(target, day, key, day_rows)
    d = day.select(*[c(n) for n in cols])
    return d.join(hit, c(key) == F.col("__tl_k"), "left_anti")


def merge_upsert(target: DataFrame, day: DataFrame, key: str, check_unique: bool = True,
                 day_rows: int | None = None, hot: dict | None = None) -> DataFrame:
    """Target after ``MERGE INTO target USING day ON target.key = day.key``.

    ``day_rows`` (the day's row count, when known, e.g. from the written
    day's metadata) sizes the filter of the day's keys; ``hot`` are the
    target's hot keys, when known.
    """
    if key not in target.columns:
        raise ValueError(f"target has no key column {key!r}")
    if check_unique:
        assert_unique_keys(day, key)
    upd = merge_update_matched(target, day, key, hot)
    ins = merge_insert_unmatched(target, day, key, day_rows)
    return upd.unionByName(ins)
