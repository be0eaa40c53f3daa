"""License scans: a trained paragraph classifier confirmed by template comparison.

A paragraph is a window of ``WINDOW`` words, taken every ``STRIDE`` words over the whole
text whatever its line breaks and comment marks, so any ``STRIDE`` words in a row, as a
wrapped notice or in the middle of a very long line, lie in one of them. (Words are runs
of letters and digits, lower-cased.) Its features are its distinct one- and
two-word n-grams that some notice holds, hashed to ``FEATURES`` columns. Only the columns
that these n-grams have are kept (some 300): the others are zero in every row, and the
coefficients and their gradients, which the driver holds, would be 50 times as large. A multinomial logistic
regression with an L1 share, so that most weights are zero, tells the licence
families of ``license_texts`` and "none" apart.

It is trained on the notices, ``VARIANTS`` altered forms of each (set between corpus
words at any place of a window, cut short) and all the corpus: every different
window that holds no notice is an example of "none". Those of an even hash, half of
them, are not trained on; all of them calibrate the unknown class: a family is accepted from the
probability that at most ``FALSE_RATE`` of them exceed (and from 0.5). A
paragraph whose best family stays below, but whose "none" is less likely than
that of all but ``FALSE_RATE`` of them (and than ``NONE_LIKELY``), is "unknown".

A predicted paragraph is compared with its family's notices: the share of a
notice's three-word n-grams it holds. From ``CONFIRM`` on the prediction is
confirmed. A finding is placed at the line where the notice's words begin; of neighbouring
windows that meet one notice, the one that holds it stands for it.

Training and prediction run on Spark's DataFrame machine learning (JVM); there
is no Python on the executors. Texts are read once and their windows' features
saved; the windows trained on are shuffled once, to count equal ones once. All are scored without
a shuffle; only findings are joined with their neighbours.

Cases: null or empty text and texts without words have no paragraph; repeated
rows give repeated findings; very long texts and lines are cut into windows in one linear step; an empty table trains on the notices alone and
finds nothing; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import cache, reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableload.llm.common import save, text_of
from tableload.llm.license_texts import NOTICES

FEATURES = 1 << 14
#: Words of a paragraph, and from one paragraph's start to the next.
WINDOW, STRIDE = 96, 48
#: Altered forms of a notice, and the corpus windows whose words stand around them.
VARIANTS, FILLERS = 12, 1_000
#: All the corpus's windows trained on weigh as much together as so many rows (one of a smaller corpus weighs one).
NONE_WEIGHT = 1_000
#: The thresholds' ranks among all windows held out are off by one in so many at most.
RANKS = 100_000
FALSE_RATE = 0.001
NONE_LIKELY = 0.25
CONFIRM = 0.6
#: Stands for a line end among the words (a character that no text's words hold).
BREAK = "\uffff"
FAMILIES = sorted(NOTICES)
NONE = len(FAMILIES)


def _grams(text: str, n: int = 3) -> list[str]:
    """Distinct n-word n-grams of a notice (the words that ``tokens`` gives)."""
    words = [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]
    return sorted({" ".join(words[i : i + n]) for i in range(len(words) - n + 1)})


#: The one-, two- and three-word n-grams of all notices.
NOTICE_GRAMS = {n: sorted({g for texts in NOTICES.values() for t in texts for g in _grams(t, n)}) for n in (1, 2, 3)}


def tokens(text: Column) -> Column:
    """Lower-cased words of a paragraph: runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, window, line, marked, words): every window with a word, its number and the line it begins in, from 0.

    ``marked`` are its words with a ``BREAK`` for every line end.
    """
    marked = F.array_remove(F.split(F.replace(F.lower(text_of()), F.lit("\n"), F.lit(f" {BREAK} ")), rf"[^\p{{L}}\p{{N}}{BREAK}]+"), "")
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (WINDOW - STRIDE), F.lit(1)), F.lit(STRIDE))
    cut = F.transform(starts, lambda i: F.struct(F.slice("all", i, F.lit(STRIDE)).alias("head"), F.slice("all", i + STRIDE, F.lit(WINDOW - STRIDE)).alias("tail")))

    def lines_in(x: Column) -> Column:
        return F.size(F.filter(x, lambda w: w == BREAK))

    start = F.struct(F.lit(0).alias("line"), F.array().cast("array<int>").alias("at"))
    ends = F.aggregate("cut", start, lambda a, x: F.struct((a["line"] + lines_in(x["head"])).alias("line"), F.concat(a["at"], F.array(a["line"])).alias("at")))
    one = docs.select("doc_id", marked.alias("all")).select("doc_id", cut.alias("cut"))
    one = one.select("doc_id", F.posexplode(F.arrays_zip(F.col("cut"), ends["at"].alias("line"))).alias("window", "one"))
    one = one.select("doc_id", "window", "one.line", F.concat("one.cut.head", "one.cut.tail").alias("marked"))
    return one.withColumn("words", F.array_remove("marked", BREAK)).where(F.size("words") > 0)


@cache
def columns() -> tuple[list[str], dict[str, str]]:
    """An n-gram of every feature column that some notice's n-gram is hashed to, in order, and of the n-grams hashed to another's column that other one."""
    hashed = HashingTF(numFeatures=FEATURES)
    at = {g: hashed.indexOf(g) for n in (1, 2) for g in NOTICE_GRAMS[n]}
    first = {}
    for g, i in at.items():
        first.setdefault(i, g)
    return [first[i] for i in sorted(first)], {g: first[i] for g, i in at.items() if first[i] != g}


def with_features(df: DataFrame) -> DataFrame:
    """Add threes (the three-word n-grams of notices that the words hold) and the hashed one- and two-word ones."""

    def next_to(a: str, k: int) -> Column:
        return F.zip_with(a, F.slice("known", F.lit(k + 1), F.greatest(F.size("known"), F.lit(1))), lambda x, y: F.concat(x, F.lit(" "), y))

    def of_notices(a: Column, n: int) -> Column:
        return F.transform(a, lambda x: F.when(x.isin(*NOTICE_GRAMS[n]), x))

    # null stands for a word or n-gram that no notice holds, so that neighbours stay neighbours
    df = df.withColumn("known", of_notices(F.col("words"), 1))
    df = df.withColumn("twos", of_notices(next_to("known", 1), 2))
    df = df.withColumn("threes", F.array_distinct(F.array_compact(of_notices(next_to("twos", 2), 3))))
    names, shared = columns()
    df = df.withColumn("grams", F.array_distinct(F.array_compact(F.concat("known", "twos"))))
    if shared:
        df = df.withColumn("grams", F.transform("grams", lambda x: reduce(lambda out, g: F.when(x == g, shared[g]).otherwise(out), shared, x)))
    found = CountVectorizerModel.from_vocabulary(names, "grams", "features", binary=True).transform(df)
    return found.drop("known", "twos", "grams")


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, window, line, marked, h, threes, features) of every window, saved; ``marked`` only where threes are held."""
    rows = with_features(paragraphs(docs)).withColumn("marked", F.when(F.size("threes") > 0, F.col("marked")))
    return save(rows.select("doc_id", "window", "line", "marked", F.xxhash64("words").alias("h"), "threes", "features"), "license-windows")


def notices(spark: SparkSession) -> DataFrame:
    """(family, label, words) of every notice."""
    rows = [(f, FAMILIES.index(f), text) for f in FAMILIES for text in NOTICES[f]]
    return spark.createDataFrame(rows, "family string, label int, text string").select("family", "label", tokens(F.col("text")).alias("words"))


def held_share(threes: Column, text: str) -> Column:
    """Share of a notice's three-word n-grams that are among ``threes``."""
    own = _grams(text)
    return F.size(F.array_intersect(threes, F.array(*map(F.lit, own)))) / max(len(own), 1)


def likeness(threes: Column, family: Column) -> Column:
    """Largest share of one of the family's notices that ``threes`` holds."""
    shares = {f: F.greatest(*[held_share(threes, t) for t in NOTICES[f]]) for f in FAMILIES}
    return reduce(lambda out, f: F.when(family == f, shares[f]).otherwise(out), FAMILIES, F.lit(0.0))


def none_rows(rows: DataFrame) -> DataFrame:
    """(h, features, held): every different window of the corpus that is an example of "none" (held: not trained on)."""
    # windows that hold a notice are not; most hold no three-word n-gram of any
    near = F.greatest(*[held_share(F.col("threes"), t) for f in FAMILIES for t in NOTICES[f]])
    rows = rows.where((F.size("threes") == 0) | (near < 0.3)).select("h", "features").dropDuplicates(["h"])
    return save(rows.withColumn("held", F.pmod(F.xxhash64("h"), F.lit(2)) == 0), "license-none")


def fillers(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(nth, fill): the words of FILLERS corpus windows (those of smallest hash), numbered from 1; altered notices stand among them."""
    chosen = rows.where("doc_id is not null and size(threes) = 0").groupBy("h").agg(F.min("doc_id").alias("doc_id")).orderBy("h").limit(FILLERS)
    chosen = save(chosen, "license-chosen")
    texts = docs.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    held = paragraphs(texts).select("words", F.xxhash64("words").alias("h")).join(F.broadcast(chosen.select("h")), "h", "left_semi").dropDuplicates(["h"])
    return save(held.select(F.row_number().over(Window.orderBy("h")).alias("nth"), F.col("words").alias("fill")), "license-fillers")


def notice_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(label, words): notices and their variants."""
    whole = notices(docs.sparkSession).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    whole = whole.withColumn("nth", F.pmod(F.xxhash64("words", "v"), F.lit(FILLERS)) + 1)
    varied = whole.join(fillers(docs, rows), "nth", "left").withColumn("fill", F.coalesce("fill", F.array().cast("array<string>")))
    # a third alone, the others with words before and after, as many as fill the window, every fourth cut short
    cut = F.when(F.col("v") % 4 == 3, F.slice("words", F.lit(1), F.greatest(F.ceil(F.size("words") * 0.8).cast("int"), F.lit(4)))).otherwise(F.col("words"))
    varied = varied.withColumn("words", cut).withColumn("room", F.greatest(F.lit(WINDOW) - F.size("words"), F.lit(0)))
    before = (F.col("room") * (F.col("v") % 5) / 4).cast("int")
    after = F.when(F.col("v") % 2 == 0, F.col("room") - before).otherwise(F.least(F.lit(8), F.col("room") - before))
    text = F.when(F.col("v") % 3 == 0, F.col("words")).otherwise(F.concat(F.slice("fill", F.lit(1), before), "words", F.slice("fill", before + 1, after)))
    return varied.select("label", text.alias("words"))


def train(docs: DataFrame, rows: DataFrame | None = None) -> tuple[LogisticRegressionModel, float, float]:
    """The classifier, and the calibrated probabilities: a family's from which it is accepted, "none"'s below which it is not.

    ``rows`` are the corpus's ``windows`` where they are there already.
    """
    rows = windows(docs) if rows is None else rows
    corpus = none_rows(rows)
    n = corpus.where("not held").count()
    none = docs.sparkSession.createDataFrame([(NONE, ["-"])], "label int, words array<string>")
    known = with_features(notice_rows(docs, rows).union(none)).withColumn("weight", F.when(F.col("label") == NONE, 1.0).otherwise(2.0))
    learnt = corpus.where("not held").select(F.lit(NONE).alias("label"), "features", F.lit(min(1.0, NONE_WEIGHT / max(n, 1))).alias("weight"))
    learnt = learnt.unionByName(save(known.select("label", "features", "weight"), "license-notices"))
    learner = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=40, regParam=0.002, elasticNetParam=0.3, family="multinomial", standardization=False)
    model = learner.fit(learnt)
    p = F.slice(vector_to_array("probability"), 1, NONE)
    held = model.transform(corpus.where("held")).select(F.array_max(p).alias("p"), F.get(vector_to_array("probability"), F.lit(NONE)).alias("none"))
    limits = held.agg(F.percentile_approx("p", 1.0 - FALSE_RATE, RANKS).alias("p"), F.percentile_approx("none", FALSE_RATE, RANKS).alias("none")).first()
    return model, max(0.5, limits["p"] or 0.0), NONE_LIKELY if limits["none"] is None else min(NONE_LIKELY, limits["none"])


def notice_line(marked: Column, line: Column, family: Column) -> Column:
    """The line in which the first three-word n-gram of a family's notices begins (the window's own line without one)."""
    own = reduce(lambda out, f: F.when(family == f, F.array(*[F.lit(g) for t in NOTICES[f] for g in _grams(t)])).otherwise(out), FAMILIES, F.array().cast("array<string>"))
    # each word with the number of line ends before it; two cells on is the next word but for line ends
    kept = F.filter(F.transform(marked, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"] != BREAK)
    threes = F.transform(kept, lambda x, k: F.struct(F.concat_ws(" ", x["w"], F.get(kept, k + 1)["w"], F.get(kept, k + 2)["w"]).alias("g"), x["i"].alias("i")))
    first = F.get(F.filter(threes, lambda x: F.array_contains(own, x["g"])), F.lit(0))["i"]
    passed = F.size(F.filter(F.slice(marked, F.lit(1), F.coalesce(first, F.lit(0))), lambda w: w == BREAK))
    return line + F.when(marked.isNull(), 0).otherwise(passed)


def scan(docs: DataFrame, model: LogisticRegressionModel, accept: float, doubt: float, rows: DataFrame | None = None) -> DataFrame:
    """(doc_id, paragraph, family, probability, likeness, confirmed) of every notice, ``paragraph`` being its line.

    ``rows`` are the documents' ``windows`` where they are there already.
    """
    p = vector_to_array("probability")
    df = model.transform(windows(docs) if rows is None else rows).select("doc_id", "window", "line", "marked", "threes", p.alias("p"))
    best = F.array_max(F.slice("p", 1, NONE))
    df = df.withColumn("best", best).where((F.col("best") >= accept) | (F.get("p", F.lit(NONE)) < doubt))
    name = F.get(F.array(*[F.lit(f) for f in FAMILIES]), (F.array_position("p", F.col("best")) - 1).cast("int"))
    df = df.withColumn("guess", name).withColumn("likeness", likeness(F.col("threes"), F.col("guess")))
    family = F.when(F.col("best") >= accept, F.col("guess")).otherwise("unknown")
    sure = (F.col("best") >= accept) & (F.col("likeness") >= CONFIRM)
    at = notice_line(F.col("marked"), F.col("line"), F.col("guess"))
    found = df.select("doc_id", "window", at.alias("paragraph"), family.alias("family"), F.col("best").alias("probability"), "likeness", sure.alias("confirmed"))
    found = save(found, "license-found")
    near = found.where("confirmed").select(F.col("doc_id").alias("id"), F.col("window").alias("w"), F.col("paragraph").alias("l"), F.col("family").alias("f"), F.col("likeness").alias("held")).distinct()
    # a window that touches a notice which its neighbour holds, holds less of it, or holds the one that the window before holds
    beside = F.abs(F.col("w") - F.col("window")) <= 1
    less = (F.col("f") == F.col("family")) & (F.col("held") > F.col("likeness"))
    same = (F.col("f") == F.col("family")) & (F.col("w") < F.col("window")) & (F.col("l") == F.col("paragraph")) & (F.col("held") == F.col("likeness"))
    stands = found.join(near, F.col("doc_id").eqNullSafe(F.col("id")) & beside & (~F.col("confirmed") | less | same), "left_anti")
    return stands.drop("window")


def license_findings(docs: DataFrame) -> DataFrame:
    """Train on all the corpus's paragraphs, then scan them."""
    rows = windows(docs)
    return scan(docs, *train(docs, rows), rows)
