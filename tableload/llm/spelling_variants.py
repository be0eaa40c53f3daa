"""Spelling variant grouping by Bloom-guided neighbourhoods.

Two words are near when they differ by exactly one inserted, deleted or replaced
code point. A word's form is its most frequent near word, if that is at least
``RATIO`` times as frequent, and its root is where its forms lead.

1. ``vocabulary``: words are counted map-side first, so a task sends a frequent
   word once.
2. ``filters``: words are hashed into blocked Bloom filters (``BLOCK_WORDS`` * 64 bits
   a block, ``WORD_BITS`` bits a key, eight bits set), one for each length. The filters of one
   pass are broadcast; they hold at most ``PASS_WORDS`` words (64 MiB), and a larger
   vocabulary takes several passes, a crowded length by parts of its hash.
3. ``near_words``: every word generates its replacements by a later letter and
   its deletions (the other half of the edits are those of the near words), as
   hashes changed in place. Only those that their length's filter holds are
   spelled out and shuffled to an exact join with the vocabulary, which removes the
   false positives.
4. Pairs are aggregated by word, both ways; a word of length L has at most 180 L + 90 near
   words. Forms rise in frequency, so following them ends; pointers are doubled.

Words have letters up to U+00FF, so they are handled as one byte a letter; the
hash of a word is a sum over its places, so any edit's hash takes one step.

Cases: null or empty text has no words; a null doc_id counts as the empty text
where its runs are hashed; rows that repeat count each time; a very long word is
edited in slices of its places; ties between forms go to the smaller word by code points;
an empty table or no word frequent enough gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableload.llm.common import ascii_lower, save, text_of

#: Letters of a lower-cased run (A-Z are gone) as bytes of Latin-1, and as a regex class.
LETTERS = np.r_[np.arange(ord("a"), ord("z") + 1), np.arange(0xC0, 0x100)].astype(np.uint8)
LETTER_CLASS = r"a-zÀ-ÿ"
#: A run whose hash this divides loses a letter.
DROP_EVERY = 199
LEAST_CHARS, LEAST_COUNT, RATIO = 6, 5, 5
#: Filter: 64-bit words a block, bits a key; blocks of one stored slice; words of one pass.
BLOCK_WORDS, WORD_BITS, SLICE_BLOCKS, PASS_WORDS = 4, 16, 4096, 1 << 25
#: Words from this length on share a filter, so the number of filters is bounded.
LONG = 64
#: Words a probing task has at least, and edits hashed at once.
TASK_WORDS, CELLS = 8_192, 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, bijective."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def at_place(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """What a letter at a place adds to a word's sum."""
    return mix((place.astype(np.uint64) + np.uint64(1)) * np.uint64(256) + letter.astype(np.uint64))


def sums(words: np.ndarray) -> np.ndarray:
    """The sum of every row of an (n, length) letter matrix."""
    return at_place(np.arange(words.shape[1])[None, :], words).sum(axis=1, dtype=np.uint64)


def shard_of(length: int) -> int:
    return min(length, LONG)


class Filter:
    """One length's part of the vocabulary in blocks of BLOCK_WORDS * 64 bits."""

    def __init__(self, blocks: np.ndarray, part: int, parts: int):
        self.blocks, self.part, self.parts = blocks, part, parts

    def hold(self, total: np.ndarray, length: int) -> np.ndarray:
        """Places in ``total`` (sums of words of ``length``) that the filter holds."""
        place, masks = places(total, length, len(self.blocks))
        left = np.flatnonzero(part_of(total, length, self.parts) == self.part) if self.parts > 1 else np.arange(len(total))
        for j in range(BLOCK_WORDS):
            m = masks(j, left)
            left = left[(self.blocks[place[left], j] & m) == m]
        return left


def keyed(total: np.ndarray, length: int) -> np.ndarray:
    return mix(total + np.uint64(length * 0x9E3779B97F4A7C15 % 2**64))


def part_of(total: np.ndarray, length: int, parts: int) -> np.ndarray:
    return keyed(total, length) % np.uint64(parts)


def places(total: np.ndarray, length: int, n_blocks: int):
    """Block of every key, and its mask in the j-th word of the block: two bits."""
    key = keyed(total, length)
    block = ((key >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32)
    bits = mix(key ^ np.uint64(0x5851F42D4C957F2D))

    def masks(j: int, at) -> np.ndarray:
        one, two = (bits[at] >> np.uint64(12 * j + s) & np.uint64(63) for s in (0, 6))
        return np.uint64(1) << one | np.uint64(1) << two

    return block.astype(np.int64), masks


def letters(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(-1, length)


def by_length(pdf: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame]]:
    yield from pdf.groupby(pdf["word"].str.len().astype("int64"), sort=False)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): letter runs of all texts, some without one letter, that are long and frequent enough."""
    text = ascii_lower(text_of())
    runs = F.filter(F.split(text, f"[^{LETTER_CLASS}]+"), lambda w: F.length(w) >= LEAST_CHARS)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    short = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    rows = rows.withColumn("h", h).withColumn("at", at).select(F.when(F.col("h") % DROP_EVERY == 0, short).otherwise(F.col("run")).alias("word"))
    return rows.groupBy("word").agg(F.count("*").alias("n")).where((F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_CHARS))


def passes(counts: dict[int, int]) -> list[list[tuple[int, int, int, int]]]:
    """(shard, part, parts, blocks) of each pass: filters of at most PASS_WORDS words together."""
    out, room = [], 0
    for shard, n in sorted(counts.items()):
        parts = -(-n // PASS_WORDS)
        held = -(-n // parts)
        for part in range(parts):
            if held > room:
                out.append([])
                room = PASS_WORDS
            out[-1].append((shard, part, parts, max(1, -(-held * WORD_BITS // (64 * BLOCK_WORDS)))))
            room -= held
    return out


def filters(words: DataFrame, units: list[tuple[int, int, int, int]]) -> dict[int, list[Filter]]:
    """The filters of one pass by shard, built in slices of SLICE_BLOCKS blocks."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for length, group in by_length(pdf):
                total = sums(letters(group["word"].tolist(), length))
                for u, (shard, part, parts, n_blocks) in enumerate(units):
                    if shard == shard_of(length):
                        mine = total[part_of(total, length, parts) == part]
                        block, _ = places(mine, length, n_blocks)
                        yield pd.DataFrame({"unit": u, "slice": block // SLICE_BLOCKS, "total": mine.view(np.int64), "length": length})

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        u, s = int(pdf["unit"].iloc[0]), int(pdf["slice"].iloc[0])
        blocks = np.zeros((SLICE_BLOCKS, BLOCK_WORDS), np.uint64)
        for length, group in pdf.groupby("length"):
            block, masks = places(group["total"].to_numpy().view(np.uint64), int(length), units[u][3])
            for j in range(BLOCK_WORDS):
                np.bitwise_or.at(blocks[:, j], block - s * SLICE_BLOCKS, masks(j, slice(None)))
        return pd.DataFrame({"unit": [u], "slice": [s], "bits": [blocks.tobytes()]})

    hashed = words.mapInPandas(keys, "unit int, slice long, total long, length int")
    made = hashed.groupBy("unit", "slice").applyInPandas(fill, "unit int, slice long, bits binary")
    blocks = [np.zeros((n + SLICE_BLOCKS, BLOCK_WORDS), np.uint64) for *_, n in units]
    for r in made.toLocalIterator():  # slices of 128 KiB, 64 MiB a pass at most
        at = r["slice"] * SLICE_BLOCKS
        blocks[r["unit"]][at : at + SLICE_BLOCKS] = np.frombuffer(r["bits"], np.uint64).reshape(-1, BLOCK_WORDS)
    out: dict[int, list[Filter]] = {}
    for (shard, part, parts, n), b in zip(units, blocks, strict=True):
        out.setdefault(shard, []).append(Filter(b[:n], part, parts))
    return out


def replaced(words: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, letter, sum) of every replacement of a letter at places first..last by a later letter."""
    total, old = sums(words), words[:, first:last]
    place = np.arange(first, last)
    gone = total[:, None] - at_place(place[None, :], old)
    new = at_place(place[:, None], LETTERS[None, :])
    row, at, letter = np.nonzero(LETTERS[None, None, :] > old[:, :, None])
    return row, at + first, LETTERS[letter], gone[row, at] + new[at, letter]


def shortened(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, sum) of every different deletion: only the first of equal neighbours goes."""
    n, length = words.shape
    place = np.arange(length)
    zero = np.zeros((n, 1), np.uint64)
    before = np.c_[zero, np.cumsum(at_place(place[None, :], words), axis=1, dtype=np.uint64)]
    moved = at_place(place[None, :] - 1, words)
    after = np.c_[np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1], zero]
    total = before[:, :-1] + after[:, 1:]
    row, at = np.nonzero(np.c_[np.ones((n, 1), bool), words[:, 1:] != words[:, :-1]])
    return row, at, total[row, at]


def probe(batches: Iterator[pd.DataFrame], held: dict[int, list[Filter]]) -> Iterator[pd.DataFrame]:
    """(word, n, near): every edit of a word that a filter holds, spelled out."""
    for pdf in batches:
        for length, group in by_length(pdf):
            same, below = held.get(shard_of(length), []), held.get(shard_of(length - 1), [])
            if not same and not below:
                continue
            step = max(1, CELLS // (length * len(LETTERS)))
            width = max(1, CELLS // (step * len(LETTERS)))
            for i in range(0, len(group), step):
                part = group.iloc[i : i + step]
                names, counts = part["word"].tolist(), part["n"].to_numpy()
                words = letters(names, length)
                hits: list[tuple[int, str]] = []
                if same:
                    for first in range(0, length, width):
                        row, at, letter, total = replaced(words, first, min(first + width, length))
                        for f in same:
                            k = f.hold(total, length)
                            hits += [(r, names[r][:p] + chr(c) + names[r][p + 1 :]) for r, p, c in zip(row[k], at[k], letter[k], strict=True)]
                if below and length > LEAST_CHARS:
                    row, at, total = shortened(words)
                    for f in below:
                        k = f.hold(total, length - 1)
                        hits += [(r, names[r][:p] + names[r][p + 1 :]) for r, p in zip(row[k], at[k], strict=True)]
                if hits:
                    rows = np.array([r for r, _ in hits])
                    yield pd.DataFrame({"word": part["word"].to_numpy()[rows], "n": counts[rows], "near": [w for _, w in hits]})


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of all near pairs, both ways, written to the scratch folder."""
    spark = words.sparkSession
    shard = F.least(F.length("word"), F.lit(LONG))
    counts = {r["shard"]: r["count"] for r in words.groupBy(shard.alias("shard")).count().collect()}  # one row a length
    tasks = max(1, min(spark.sparkContext.defaultParallelism, sum(counts.values())), sum(counts.values()) // TASK_WORDS)
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    schema = "word string, n long, near string, near_n long"
    pairs = spark.createDataFrame([], schema)
    for units in passes(counts):
        held = spark.sparkContext.broadcast(filters(words, units))
        wanted = sorted({s for s, *_ in units} | {shard_of(s + 1) for s, *_ in units})
        positives = words.where(shard.isin(wanted)).repartition(tasks).mapInPandas(lambda b, held=held: probe(b, held.value), "word string, n long, near string")
        pairs = pairs.union(save(positives.join(known, "near").select("word", "n", "near", "near_n"), "near-words"))
    return pairs.union(pairs.select("near", "near_n", "word", "n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: pointers are doubled until no root has a form."""
    at = save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if at.join(on, "root", "left_semi").isEmpty():
            return at
        at = save(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word that is long and frequent enough."""
    words = save(vocabulary(docs), "vocabulary")
    pairs = near_words(words)
    top = F.min(F.struct((-F.col("near_n")).alias("by"), F.col("near").alias("form")))
    of_word = pairs.groupBy("word").agg(F.count("*").alias("n_near"), top.alias("top"))
    enough = -F.col("top.by") >= RATIO * F.col("n")
    rows = words.join(of_word, "word", "left").select(
        "word",
        F.when(enough, F.col("top.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, -F.col("top.by")).alias("form_n"),
    )
    rows = save(rows, "forms")
    led = rows.join(roots(rows.where("form is not null")), "word", "left")
    return led.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
