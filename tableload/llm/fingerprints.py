"""Document fingerprints: one-permutation MinHash, densified, b bits a bin.

A text's five-word shingles are hashed once. The hash's high bits choose one
of ``BINS`` bins and each bin keeps its smallest hash. Empty bins are filled by
optimal densification: bin i asks the bins that a hash of (i, attempt) names
until one is not empty; after ``PROBES`` attempts it goes on along a fixed
random order of all bins, so the search always ends. Of each bin ``BITS`` low
bits are kept, packed into longs. The share of equal bins is corrected for the
2^-BITS chance of accidental agreement.

Only DataFrame functions are used. Within a row: hashes and one sentinel a bin
are sorted together, the first entry of each bin is its minimum, and a bin
whose first entry is the sentinel is empty.

Cases: null text counts as empty; a text with fewer than five words is one
shingle of its whole word sequence; a text without words has no fingerprint
(empty string), likeness 1 with another such text and 0 with any other; an
empty table gives an empty result; repeated rows give repeated results; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableload.llm.common import WS_CHARS, WS_CLASS, block_of, id_bounds, long_array, text_of

SHINGLE = 5
BINS = 512  # a power of two
BITS = 4  # 16 bins to a long
PROBES = 24

_SHIFT = 64 - BINS.bit_length()  # hashes have 63 bits, the highest choose the bin
_LOW = (1 << _SHIFT) - 1
_LANES = 64 // BITS
_LANE_ONES = sum(1 << (BITS * k) for k in range(_LANES))


def with_shingle_hashes(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: hashes (63 bits) of all five-word shingles, repeats included.

    One hash of the whole word sequence for fewer than five words, null without
    words. Word hashes are combined pairwise, pairs to fours, fours with the
    fifth word.
    """
    bare = F.btrim(F.col(text), F.lit(WS_CHARS))
    df = df.withColumn("__w", F.when(bare != "", F.transform(F.split(bare, f"[{WS_CLASS}]+"), lambda w: F.xxhash64(w))))
    n = F.size("__w")
    df = df.withColumn("__2", F.when(n >= SHINGLE, F.zip_with("__w", F.slice("__w", 2, n), lambda a, b: F.xxhash64(a, b))))
    df = df.withColumn("__4", F.zip_with("__2", F.slice("__2", 3, n), lambda a, b: F.xxhash64(a, b)))
    five = F.zip_with(F.slice("__4", F.lit(1), n - 4), F.slice("__w", F.lit(5), n), lambda a, b: F.shiftrightunsigned(F.xxhash64(a, b), 1))
    whole = F.array(F.shiftrightunsigned(F.xxhash64("__w"), 1))
    return df.withColumn(out, F.when(n >= SHINGLE, five).when(n > 0, whole)).drop("__w", "__2", "__4")


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the packed fingerprint of column ``text`` as array<bigint>, null without words.

    Every step is a projection of its own, referenced more than once by the
    next, so Spark evaluates it once a row.
    """
    sentinels = long_array([(b << _SHIFT) | _LOW for b in range(BINS)])

    def bin_of(x: Column) -> Column:
        return F.shiftright(x, _SHIFT)

    def low_bits(x: Column) -> Column:
        # the sentinel has all low bits set; a bin that holds nothing else is empty
        return F.when(x.bitwiseAND(F.lit(_LOW)) != _LOW, x.bitwiseAND(F.lit((1 << BITS) - 1)))

    df = with_shingle_hashes(df, text, "__h")
    df = df.withColumn("__s", F.sort_array(F.concat("__h", sentinels))).drop("__h")
    first = F.filter("__s", lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get("__s", i - 1))))
    df = df.withColumn("__v", F.transform(first, low_bits)).drop("__s")
    filled = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.get("__v", j).isNotNull())
    df = df.withColumn("__f", F.when(F.col("__v").isNotNull(), filled))

    def dense(x: Column, i: Column) -> Column:
        tries = [F.get("__v", F.xxhash64(i, F.lit(t)).bitwiseAND(F.lit(BINS - 1)).cast("int")) for t in range(PROBES)]

        def ranked(j: Column) -> Column:
            return F.shiftleft(F.shiftrightunsigned(F.xxhash64(i, j, F.lit(PROBES)), 16), 15).bitwiseOR(j.cast("long"))

        last = F.array_min(F.transform("__f", ranked)).bitwiseAND(F.lit(BINS - 1))
        return F.lpad(F.hex(F.coalesce(x, *tries, F.get("__v", last.cast("int")))), BITS // 4, "0")

    df = df.withColumn("__d", F.array_join(F.transform("__v", dense), "")).drop("__v", "__f")

    def lane(word: Column) -> Column:
        return F.conv(F.substr("__d", word * 16 + 1, F.lit(16)), 16, -10).cast("bigint")

    packed = F.transform(F.sequence(F.lit(0), F.lit(BINS // _LANES - 1)), lane)
    return df.withColumn(out, F.when(F.col("__d").isNotNull(), packed)).drop("__d")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two packed fingerprints, corrected for chance agreement."""

    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for step in (1 << k for k in range(BITS.bit_length() - 1)):
            d = d.bitwiseOR(F.shiftrightunsigned(d, step))
        return F.bit_count(d.bitwiseAND(F.lit(_LANE_ONES)))

    unequal = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / (1 << BITS)
    estimate = ((F.lit(1.0) - unequal / F.lit(float(BINS))) - chance) / (1.0 - chance)
    both = F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(both)


def as_hex(packed: Column) -> Column:
    """The packed fingerprint as lower-case hex, the empty string for none."""
    return F.coalesce(F.lower(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), "")), F.lit(""))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, packed, fingerprint) of every whole text; no shuffle."""
    df = docs.select("doc_id", text_of().alias("__t"))
    df = with_fingerprint(df, "__t", "packed")
    return df.select("doc_id", F.length("__t").cast("long").alias("n_chars"), "packed", as_hex(F.col("packed")).alias("fingerprint"))


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    The next document is the one before it in doc_id (the largest one after
    the smallest); rows of one doc_id are taken in text order, null ids come
    last. The edited text has its last floor(n/2) code points replaced by the
    next document's first as many.

    Documents are dealt into equal-depth id blocks and each block also gets the
    last block row of its lower neighbour, so the text is shuffled once and no
    window spans the table.
    """
    bounds = id_bounds(docs, "doc_id")
    blocks = max(1, len(bounds))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    df = with_fingerprint(df, "text", "packed").withColumn("block", block_of(F.col("doc_id"), bounds))
    # the largest id of a block is the successor of the next block's smallest, around the end too
    edge = F.get(long_array([hi for _, hi in bounds]), F.col("block")) == F.col("doc_id") if bounds else F.lit(True)
    own, extra = F.struct(F.col("block").alias("b"), F.lit(0).alias("guest")), F.struct(((F.col("block") + 1) % blocks).alias("b"), F.lit(1).alias("guest"))
    df = df.withColumn("at", F.explode(F.when(edge, F.array(own, extra)).otherwise(F.array(own))))
    order = Window.partitionBy("at.b").orderBy("at.guest", F.col("doc_id").desc_nulls_last(), "text")
    df = df.select("*", F.lead("text").over(order).alias("next_text"), F.lead("packed").over(order).alias("next_packed"))
    df = df.where("at.guest = 0").drop("at", "block")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half))
    df = df.withColumn("edited", edited).withColumn("n_chars", F.length("text").cast("long")).drop("text", "next_text")
    df = with_fingerprint(df, "edited", "edited_packed")
    return df.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_hex(F.col("packed")).alias("fingerprint"),
        as_hex(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"),
        likeness(F.col("packed"), F.col("next_packed")).alias("near_next"),
    )
