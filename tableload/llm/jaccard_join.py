"""N-gram Jaccard join by T-occurrence search, and the groups its links make.

A document's set is its distinct five-word shingles (64-bit hashes; A-Z
lower-cased). Two documents link when 100 * intersection >= 75 * union. A link
needs an overlap of at least T = ceil(0.75 * size) tokens of either set, so in
any one order of tokens two linked sets also share ``l`` tokens within their
first size - T + l (``l`` the smaller of the two documents' own choice).

1. ``set_rows``: size, set digest and the first three eighths of every set in
   hash order. Equal sets form a class; the smallest doc_id stands for it.
2. ``survivors``: tokens found in one document only cannot be shared; documents
   left with fewer shared tokens in their prefix than a link needs are out.
3. ``ranked_sets``: the survivors' whole sets, counted again among each other
   and ordered by rising frequency.
4. ``star_links``: each list's smallest document is checked against the list's
   others, the two best such leaders a document. Groups of near copies, however
   large, become connected by a linear number of checks.
5. ``search`` (DivideSkip): a document's rare prefix lists (at most
   ``SHORT_LIST`` entries) are heap-merged, keeping the partners that occur
   often enough, given the pair's own T and the long lists left out. Partners
   in the same component need no check. Partners met in long lists only are
   found by block, from their rarest tokens and only across components.
6. ``check``: a candidate's tokens are binary-probed in the partner's sorted
   set, which decides exactly.

Nothing is capped: leaders in step 4 only save work, step 5 covers every pair
of documents that are not yet in one component. All tables between the steps
are written to the scratch folder.

Cases: null or empty text, or text without words, has size 0 and links with
nothing; fewer than five words make one shingle; rows that repeat a doc_id
must repeat its text and share its component; a null doc_id has a null
component; an empty table gives an empty result; other columns are ignored by
the report and kept by ``keep_one_each``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tableload.llm.common import save, text_of
from tableload.llm.graph import components

SHINGLE = 5
#: A link needs NUM / DEN similarity.
NUM, DEN = 75, 100
SHORT_LIST = 64

_RNG = np.random.default_rng(20_259)
_BYTES = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(n: int, base: int, _kept: dict = {}) -> np.ndarray:  # noqa: B006 - a cache a worker
    """base ** (0..n-1) modulo 2 ** 64."""
    have = _kept.get(base)
    if have is None or len(have) < n:
        size = max(1 << 14, 1 << int(n - 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        have[1:] = np.uint64(base)
        have = _kept[base] = np.multiply.accumulate(have)
    return have[:n]


_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 2**64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes (uint64) of a text; empty without words."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    inside = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * _powers(len(data), _BASE), out=sums[1:])
    word = _mix((sums[end] - sums[start]) * _powers(len(data), _INVERSE)[start] + (end - start).astype(np.uint64) * _STEP)
    k = min(SHINGLE, len(word))
    n = len(word) - k + 1
    total = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        total += word[i : i + n] * _PLACES[i]
    return np.unique(_mix(total))


def required(size: int) -> int:
    """Least overlap a set of ``size`` has with any set it links with."""
    return -(-NUM * size // DEN)


def hash_prefix(size: int) -> int:
    """Tokens of a set that step 2 looks at."""
    return min(size, max(size - required(size) + 1, -(-3 * size // 8) + 1)) if size else 0


@lru_cache(maxsize=1 << 16)
def hash_need(size: int) -> int:
    """Shared tokens within ``hash_prefix`` that a document with any link has.

    Of a pair that overlaps by o, a prefix shows all but size - o of its tokens
    from the overlap, the smallest first; the pair shares what the shorter show
    has. The least of it over every size a partner can have.
    """
    if not size:
        return 1
    other = np.arange(required(size), DEN * size // NUM + 1)
    both = pair_overlap(size, other)
    prefix = np.minimum(other, np.maximum(other - -(-NUM * other // DEN) + 1, -(-3 * other // 8) + 1))
    return int(np.minimum(hash_prefix(size) - (size - both), prefix - (other - both)).min())


def set_rows(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (hex, null for the empty set), need and prefix (array<long>) of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(t) for t in pdf["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"],
                    "n_shingles": [len(s) for s in sets],
                    "digest": [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets],
                    "need": [hash_need(len(s)) for s in sets],
                    "prefix": [s[: hash_prefix(len(s))].view(np.int64) for s in sets],
                }
            )

    body = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return body.mapInPandas(run, "doc_id long, n_shingles long, digest string, need int, prefix array<long>")


def survivors(sets: DataFrame) -> DataFrame:
    """(doc_id) of the documents whose prefix has as many tokens found elsewhere as a link needs."""
    rows = sets.where("doc_id is not null and n_shingles > 0").select("doc_id", "need", F.explode("prefix").alias("token"))
    shared = rows.withColumn("holders", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("holders > 1")
    return shared.groupBy("doc_id").agg(F.count(F.lit(1)).alias("shared"), F.first("need").alias("need")).where("shared >= need").select("doc_id")


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, tokens sorted array<long>) of the wanted documents, from their texts again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "tokens": [shingle_set(t).view(np.int64) for t in pdf["text"]]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(wanted, "doc_id", "left_semi")
    rows = rows.dropDuplicates(["doc_id"])
    return rows.mapInPandas(run, "doc_id long, tokens array<long>")


def ranked_sets(sets: DataFrame) -> DataFrame:
    """(doc_id, size, shared, prefix array<long>) of documents that still can link.

    ``shared`` counts the tokens someone else has; ``prefix`` is the rarest-first
    part of the set that step 5 searches, without the tokens nobody else has.
    """
    rows = sets.select("doc_id", F.size("tokens").alias("size"), F.explode("tokens").alias("token"))
    shared = rows.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("df > 1")
    per = shared.groupBy("doc_id", "size").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ranked"))
    t = F.ceil(F.col("size") * NUM / DEN).cast("int")
    per = per.where(F.size("ranked") >= t)
    own = search_need(F.col("size"))
    length = F.col("size") - t + own - (F.col("size") - F.size("ranked"))
    prefix = F.transform(F.slice("ranked", F.lit(1), length), lambda x: x["token"])
    return per.select("doc_id", "size", F.size("ranked").alias("shared"), prefix.alias("prefix"))


def search_need(size: Column) -> Column:
    """l of step 5 for a set size: one token in 32, at least one, at most T."""
    return F.greatest(F.lit(1), F.least(F.ceil(size / 32), F.ceil(size * NUM / DEN))).cast("int")


def may_link(size_a: str, shared_a: str, size_b: str, shared_b: str) -> Column:
    """Whether two sets can link by their sizes and by how many of their tokens anyone shares.

    Neither overlaps more than the tokens it shares with anyone, and a link
    overlaps at least NUM / (NUM + DEN) of both sizes together.
    """
    both = F.least(size_a, shared_a, size_b, shared_b)
    return both * (NUM + DEN) >= (F.col(size_a) + F.col(size_b)) * NUM


def check(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that link: a's tokens are binary-probed in b's sorted set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            good = []
            for x, y in zip(pdf["x"], pdf["y"], strict=True):
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                x, y = x.view(np.uint64), y.view(np.uint64)
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                good.append(DEN * both >= NUM * (len(x) + len(y) - both))
            yield pdf.loc[good, ["a", "b"]]

    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def star_links(ranked: DataFrame) -> DataFrame:
    """(a, b) candidates: for each document the two leaders (smallest doc_id of a list) it meets in most lists."""
    rows = ranked.select("doc_id", "size", "shared", F.explode("prefix").alias("token"))
    lead = rows.groupBy("token").agg(F.min(F.struct("doc_id", "size", "shared")).alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = rows.join(save(lead.select("token", "lead.*").toDF("token", "a", "a_size", "a_shared"), "jaccard-lead"), "token")
    met = met.where(F.col("doc_id") > F.col("a")).where(may_link("size", "shared", "a_size", "a_shared")).groupBy("a", F.col("doc_id").alias("b")).agg(F.count(F.lit(1)).alias("met"))
    best = met.groupBy("b").agg(F.slice(F.sort_array(F.collect_list(F.struct("met", "a")), asc=False), 1, 2).alias("best"))
    return best.select(F.explode("best.a").alias("a"), "b")


def merged(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Heap-merge sorted lists: the distinct values and how often each occurs."""
    met = [(v, sum(1 for _ in same)) for v, same in groupby(heapq.merge(*(x.tolist() for x in lists)))]
    return np.array([v for v, _ in met], dtype=np.int64), np.array([k for _, k in met], dtype=np.int64)


def pair_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """T of a pair: the least overlap of two linked sets of these sizes."""
    return -(-NUM * (a + b) // (NUM + DEN))


def searched(size: np.ndarray) -> np.ndarray:
    """Tokens of a set that step 5 searches (``ranked_sets``), those that nobody else has included."""
    t = -(-NUM * size // DEN)
    return size - t + np.maximum(1, np.minimum(-(-size // 32), t))


def heap_search(mine: DataFrame) -> DataFrame:
    """(a, b): partners of each document that occur often enough in its short lists.

    A linked pair shares, of the tokens that both search, at least need = the
    smaller of searched(size) - (size - T), T being the pair's own; of these
    at most ``long`` lie in lists that were left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, b = [], []
            for doc, label, size, shared, long, docs, labels, sizes, holds, lengths in pdf.itertuples(index=False):
                # later documents of other components, list by list
                keep = (docs > doc) & (labels != label)
                ends = np.cumsum(np.r_[0, keep])[np.cumsum(lengths)]
                docs, sizes, holds = docs[keep], sizes[keep], holds[keep]
                found, met = merged([x for x in np.split(docs, ends[:-1]) if len(x)])
                if not len(found):
                    continue
                _, at = np.unique(docs, return_index=True)
                t = pair_overlap(size, sizes[at])
                need = np.minimum(searched(np.int64(size)) + t - size, searched(sizes[at]) + t - sizes[at])
                good = (met >= np.maximum(1, need - long)) & (np.minimum(min(size, shared), holds[at]) >= t)
                a += [doc] * int(good.sum())
                b += found[good].tolist()
            yield pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return mine.mapInPandas(run, "a long, b long")


def search(ranked: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b), a < b: every pair of different components that can link by the tokens it shares.

    ``labels`` (doc_id, label) holds the components so far.
    """
    at = ranked.join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    own = ["doc_id", "label", "size", "shared"]
    rows = at.select(*own, F.posexplode("prefix").alias("pos", "token"))
    # the place of a token in the whole set's order: tokens that nobody else has come first
    rows = rows.withColumn("pos", F.col("size") - F.col("shared") + F.col("pos"))
    kinds = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    # a list whose documents are all in one component has nothing left to find
    kinds = save(kinds.where("lo < hi").select("token", "n"), "jaccard-lists")
    rows = save(rows.join(kinds, "token"), "jaccard-open")

    short, long = rows.where(F.col("n") <= SHORT_LIST), save(rows.where(F.col("n") > SHORT_LIST), "jaccard-long")
    lists = short.groupBy("token").agg(F.sort_array(F.collect_list(F.struct(*own))).alias("list"))
    mine = short.join(save(lists, "jaccard-short"), "token").groupBy(*own).agg(F.collect_list("list").alias("lists"))
    mine = mine.join(long.groupBy("doc_id").agg(F.count(F.lit(1)).alias("long")), "doc_id", "left")
    mine = mine.withColumns({"flat": F.flatten("lists"), "long": F.coalesce("long", F.lit(0))})
    mine = mine.select(*own, "long", *[F.col(f"flat.{c}").alias(f"their_{c}") for c in own], F.transform("lists", lambda x: F.size(x)).alias("lengths"))

    # Long lists: a linked pair that shares no short list shares a long one within the first size - T + 1 tokens
    # of both. A list's members outside its commonest component meet all its members, by block.
    common = long.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(F.max_by("label", "k").alias("main"))
    long = long.join(save(common, "jaccard-common"), "token").withColumn("blocks", F.ceil(F.col("n") / SHORT_LIST).cast("int"))
    one = F.struct(*own, "pos")
    held = long.select("token", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block"), "main", one.alias("h"))
    asks = long.where("label <> main").select("token", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), one.alias("q"))
    t = F.ceil((F.col("q.size") + F.col("h.size")) * NUM / (NUM + DEN))
    early = (F.col("q.pos") + t <= F.col("q.size")) & (F.col("h.pos") + t <= F.col("h.size"))
    meet = (asks["token"] == held["token"]) & (asks["block"] == held["block"]) & (F.col("q.label") != F.col("h.label"))
    meet = meet & early & may_link("q.size", "q.shared", "h.size", "h.shared")
    far = asks.join(held, meet & ((F.col("h.label") == F.col("main")) | (F.col("q.doc_id") < F.col("h.doc_id"))))
    far = far.select(F.least("q.doc_id", "h.doc_id").alias("a"), F.greatest("q.doc_id", "h.doc_id").alias("b"))
    return heap_search(mine).union(far).distinct()


def links(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b) links between the class representatives ``reps`` (doc_id) that connect every group of linked documents."""
    sets = save(whole_sets(docs, reps), "jaccard-sets")
    ranked = save(ranked_sets(sets), "jaccard-ranked")
    first = save(check(star_links(ranked), sets), "jaccard-star")
    labels = components(first)
    rest = check(search(ranked, labels), sets)
    return save(first.union(rest), "jaccard-links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links, itself included) of every document."""
    sets = save(set_rows(docs), "jaccard-prefix")
    known = sets.where("doc_id is not null and n_shingles > 0")
    classes = save(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "jaccard-classes")
    reps = classes.select(F.col("rep").alias("doc_id")).join(save(survivors(sets), "jaccard-survivors"), "doc_id", "left_semi")
    labels = components(links(docs, save(reps, "jaccard-reps")))
    groups = save(classes.join(labels.withColumnRenamed("doc_id", "rep"), "rep", "left").select("digest", F.coalesce("label", "rep").alias("label")), "jaccard-groups")
    out = sets.select("doc_id", "n_shingles", "digest").join(groups, "digest", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("component_id"))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The documents that stand for their group (component_id = doc_id), all columns; null doc_ids stay."""
    gone = near_duplicates(docs.select("doc_id", "text")).where("component_id <> doc_id").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
