"""Quality rules: base rules, then robust multivariate outliers a language and source.

Counts over a document's words and lines become a vector of transformed
statistics (log mean word length; variance-stabilised shares of symbols,
repeated lines, repeated three-word windows and capital letters). For each
(language, source) the minimum covariance determinant estimate is found by
concentration steps: from two deterministic starts (median and MAD; mean and
covariance), the ``H_SHARE`` of documents with the smallest Mahalanobis
distance give the next mean and covariance, ``STEPS`` times, and the start with
the smaller determinant wins. A document is rejected when its squared distance
is over ``CUT``; where the group's median is over the chi-square median, the
distances are scaled down to it (a smaller median comes from the floors and stays).

Each covariance gets ``FLOOR`` squared on its diagonal, the spread that short
clean texts have anyway, so a group whose statistics are all alike rejects only
clear outliers. Sources with fewer than ``MIN_GROUP`` usable documents are
pooled by language, and small pools into one.

Only DataFrame functions are used. Texts are read once and reduced to one
narrow row a document (written to the scratch folder); every later step
aggregates those rows, map-side first. The join with the per-group estimates
is salted, so a hot source is spread over tasks.

Cases: null text has no words (base failed); null and empty language or
source are one group; documents that fail the base rules do not enter the
estimates; repeated rows each count; an empty table gives an empty result;
other columns are ignored by the report and kept by ``keep_quality``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableload.llm.common import WS_CHARS, lines, save, text_of, words

MIN_WORDS = 50
H_SHARE = 0.75
STEPS = 3
MIN_GROUP = 60
SALTS = 16
#: Standard deviation added to every statistic, in the order of STATS.
FLOOR = (0.06, 0.05, 0.12, 0.2, 0.05)
#: Deviation of the arcsine repeat shares of clean documents, besides that of counting (1 / (4 n)).
REPEAT_SPREAD = 0.09
STATS = ("x0", "x1", "x2", "x3", "x4")
P = len(STATS)
#: Chi-square with five degrees of freedom at 0.5, and at 0.9999.
CHI_MEDIAN = 4.3515
CUT = 25.745
#: Median absolute deviation to standard deviation, for a normal distribution.
MAD_SCALE = 1.4826
ACCURACY = 10_000


def _count(text: Column, other: str) -> Column:
    """Code points left after removing runs of ``other``."""
    return F.length(F.regexp_replace(text, other, "")).cast("long")


def with_repeat_words(df: DataFrame, word_col: str, out: str) -> DataFrame:
    """Add ``out``: words in three-word windows found twice or more in the word array.

    Windows are hashed (64 bits). Only where two hashes are equal are they
    sorted with their positions; a repeated window at s covers s to s+2, so
    the sum over sorted starts of min(3, gap to the next) is the count.
    """
    n = F.size(word_col)
    df = df.withColumn("__1", F.transform(word_col, lambda w: F.xxhash64(w)))
    df = df.withColumn("__2", F.when(n >= 3, F.zip_with("__1", F.slice("__1", F.lit(2), n), lambda a, b: F.xxhash64(a, b))))
    df = df.withColumn("__3", F.zip_with(F.slice("__2", F.lit(1), n - 2), F.slice("__1", F.lit(3), n), lambda a, b: F.xxhash64(a, b))).drop("__1", "__2")
    again = F.size(F.array_distinct("__3")) < F.size("__3")
    placed = F.transform("__3", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("__s", F.when(again, F.sort_array(placed))).drop("__3")

    def twice(x: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get("__s", k - 1)["h"])
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == F.get("__s", k + 1)["h"], F.lit(False))

    df = df.withColumn("__i", F.sort_array(F.transform(F.filter("__s", twice), lambda x: x["i"]))).drop("__s")
    gaps = F.zip_with("__i", F.slice("__i", F.lit(2), F.size("__i")), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    total = F.aggregate(gaps, F.lit(0), lambda s, x: s + x)
    return df.withColumn(out, F.coalesce(total, F.lit(0)).cast("long")).drop("__i")


def text_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, base_failed."""
    df = docs.select(*keep, text_of().alias("__t"))
    df = df.withColumns(
        {
            "n_symbols": _count(F.col("__t"), r"[^#*$%&|<>]+"),
            "n_upper": _count(F.col("__t"), r"\P{Lu}+"),
            "__w": words(F.col("__t")),
            "__l": F.filter(lines(F.col("__t")), lambda x: F.btrim(x, F.lit(WS_CHARS)) != ""),
        }
    ).drop("__t")
    df = df.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.length(F.array_join("__w", "")).cast("long"),
            "n_lines": F.size("__l").cast("long"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        }
    ).drop("__l")
    df = with_repeat_words(df, "__w", "n_repeat_words").drop("__w")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def with_vector(df: DataFrame) -> DataFrame:
    """Add the transformed statistics x0..x4.

    The repeat shares are scaled, so that their floor stands for a deviation of
    sqrt(``REPEAT_SPREAD`` ** 2 + 1 / (4 n)) in a document of n lines or words.
    """

    def share(k: str, n: str) -> Column:
        return F.asin(F.sqrt(F.least(F.lit(1.0), (F.col(k) + 0.375) / (F.col(n) + 0.75))))

    def repeats(k: str, n: str, floor: float) -> Column:
        return share(k, n) * F.lit(floor) / F.sqrt(F.lit(REPEAT_SPREAD**2) + 0.25 / F.greatest(F.col(n), F.lit(1)))

    mean_length = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    vector = [F.log(mean_length + 1), share("n_symbols", "word_chars"), repeats("n_dup_lines", "n_lines", FLOOR[2]), repeats("n_repeat_words", "n_words", FLOOR[3]), share("n_upper", "word_chars")]
    return df.withColumns(dict(zip(STATS, vector, strict=True)))


def with_group(df: DataFrame) -> DataFrame:
    """Add g: the (language, source) group, or the pool a small group falls in (its language's, then the common one)."""
    lang, source = F.coalesce(F.col("lang"), F.lit("")), F.coalesce(F.col("source"), F.lit(""))
    df = df.withColumns({"__lang": lang, "__source": source})
    sizes = df.where("not base_failed").groupBy("__lang", "__source").agg(F.count(F.lit(1)).alias("n"))
    pools = sizes.where(F.col("n") < MIN_GROUP).groupBy("__lang").agg(F.sum("n").alias("pool"))
    names = sizes.join(pools, "__lang", "left").select(
        F.col("__lang").alias("__a"),
        F.col("__source").alias("__b"),
        F.when(F.col("n") >= MIN_GROUP, F.to_json(F.array("__lang", "__source"))).when(F.col("pool") >= MIN_GROUP, F.to_json(F.array("__lang"))).otherwise("[]").alias("g"),
    )
    return salted_join(df, names, (F.col("__lang") == F.col("__a")) & (F.col("__source") == F.col("__b"))).drop("__lang", "__source", "__a", "__b")


def salted_join(rows: DataFrame, groups: DataFrame, on: Column) -> DataFrame:
    """Left join of many rows with one row (or a few) a group, each group's rows spread over ``SALTS`` keys."""
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64("__row"), F.lit(SALTS)).cast("int"))
    groups = groups.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(groups, on & (F.col("__salt") == F.col("__copy")), "left").drop("__salt", "__copy")


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(P) for j in range(i + 1)]


def _moments() -> list[Column]:
    """Aggregates: rows, means and covariances (population) of the statistics."""
    means = [F.avg(x).alias(f"m{i}") for i, x in enumerate(STATS)]
    return [F.count(F.lit(1)).alias("n"), *means, *[F.covar_pop(STATS[i], STATS[j]).alias(f"s{i}{j}") for i, j in _pairs()]]


def with_whitening(groups: DataFrame) -> DataFrame:
    """From means m and covariances s: W = inverse Cholesky factor (w), and the log determinant.

    Each entry is a column of its own, so nothing is expanded twice.
    """
    for i in range(P):
        groups = groups.withColumn(f"s{i}{i}", F.col(f"s{i}{i}") + F.lit(FLOOR[i] ** 2))
    for j in range(P):
        sub = sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        groups = groups.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"s{j}{j}") - sub, F.lit(FLOOR[j] ** 2))))
        for i in range(j + 1, P):
            sub = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            groups = groups.withColumn(f"l{i}{j}", (F.col(f"s{i}{j}") - sub) / F.col(f"l{j}{j}"))
    for j in range(P):
        groups = groups.withColumn(f"w{j}{j}", 1.0 / F.col(f"l{j}{j}"))
        for i in range(j + 1, P):
            sub = sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            groups = groups.withColumn(f"w{i}{j}", -sub / F.col(f"l{i}{i}"))
    groups = groups.withColumn("logdet", sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(P)), F.lit(0.0)))
    return groups.select("g", "start", "logdet", *[f"m{i}" for i in range(P)], *[f"w{i}{j}" for i, j in _pairs()])


def distance2() -> Column:
    """Squared Mahalanobis distance of a row's statistics under its group's estimate."""
    total = F.lit(0.0)
    for i in range(P):
        z = sum((F.col(f"w{i}{j}") * (F.col(STATS[j]) - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0))
        total = total + F.pow(z, F.lit(2.0))
    return total


def _starts(usable: DataFrame) -> DataFrame:
    """Both starting estimates of every group."""
    middle = usable.groupBy("g").agg(*[F.percentile_approx(x, 0.5, ACCURACY).alias(f"m{i}") for i, x in enumerate(STATS)])
    spread = salted_join(usable, middle.withColumnRenamed("g", "__g"), F.col("g") == F.col("__g")).groupBy("g")
    spread = spread.agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(P)],
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, ACCURACY).alias(f"d{i}") for i, x in enumerate(STATS)],
    )
    robust = spread.select("g", F.lit(0).alias("start"), *[f"m{i}" for i in range(P)], *[(F.pow(F.col(f"d{i}") * MAD_SCALE, F.lit(2.0)) if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i, j in _pairs()])
    plain = usable.groupBy("g").agg(*_moments()).select("g", F.lit(1).alias("start"), *[f"m{i}" for i in range(P)], *[f"s{i}{j}" for i, j in _pairs()])
    return with_whitening(robust.unionByName(plain))


def estimates(usable: DataFrame) -> DataFrame:
    """One row a group: the minimum covariance determinant estimate (m, w) and the distance scale."""
    current = save(_starts(usable), "mcd-start")

    def measured(groups: DataFrame) -> DataFrame:
        return salted_join(usable, groups.withColumnRenamed("g", "__g"), F.col("g") == F.col("__g")).withColumn("d2", distance2())

    for step in range(STEPS):
        limits = measured(current).groupBy("g", "start").agg(F.percentile_approx("d2", H_SHARE, ACCURACY).alias("limit"))
        current = save(current.join(limits, ["g", "start"]), f"mcd-limit{step}")
        half = measured(current).where(F.col("d2") <= F.col("limit"))
        current = save(with_whitening(half.groupBy("g", "start").agg(*_moments())), f"mcd-step{step}")
    best = current.groupBy("g").agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    current = save(current.join(best, ["g", "start"]), "mcd-best")
    scale = measured(current).groupBy("g").agg(F.percentile_approx("d2", 0.5, ACCURACY).alias("mid"))
    return current.join(scale, "g").withColumn("scale", F.greatest(F.lit(1.0), F.col("mid") / CHI_MEDIAN)).drop("start", "logdet", "mid")


def quality_verdicts(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, the counts, base_failed, distance2 (null where the base rules failed) and kept of every document."""
    keep = keep or ("doc_id",)
    rows = docs.select(*keep, "lang", "source", "text") if not {"lang", "source"} & set(keep) else docs.select(*dict.fromkeys((*keep, "lang", "source", "text")))
    stats = text_statistics(rows, *dict.fromkeys((*keep, "lang", "source")))
    stats = save(with_vector(stats).withColumn("__row", F.xxhash64(*keep, *STATS)), "mcd-stats")
    stats = save(with_group(stats), "mcd-rows")
    fit = save(estimates(stats.where("not base_failed")), "mcd-fit")
    judged = salted_join(stats, fit.withColumnRenamed("g", "__g"), F.col("g") == F.col("__g"))
    judged = judged.withColumn("distance2", F.when(~F.col("base_failed"), distance2() / F.col("scale")))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance2") <= CUT, F.lit(True))
    return judged.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance2", kept.alias("kept"))


def keep_quality(docs: DataFrame) -> DataFrame:
    """The documents whose verdict is kept, all columns as they were.

    A document is found again by its doc_id and a hash of the columns the
    verdict depends on.
    """
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_of(), F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit("")))
    rows = docs.select("doc_id", "lang", "source", "text", key.alias("__key"))
    kept = quality_verdicts(rows, "__key", "doc_id").where("kept").select(F.col("__key").alias("__kept_key"))
    return docs.join(kept, key == F.col("__kept_key"), "left_semi")
