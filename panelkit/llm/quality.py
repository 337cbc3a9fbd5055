"""Quality rules by robust multivariate outliers (operator 3).

Built-in functions only. A document's statistics are computed inside its row; the minimum covariance determinant is
then found per language and source on a narrow table of whole-number features. Every step of the search is an
aggregate over all rows, so that a source with a third of all rows is no hot spot, and sums of whole numbers don't
depend on their order, so that reruns agree.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.functions.durable import settle
from panelkit.llm.text import SPACE, words

#: limits of the base rules
MIN_WORDS = 50
MAX_REPEATED = 50

#: features are stored as whole numbers of this part of a unit
GRAIN = 256
#: each feature with the standard deviation that is added to its spread, so that a feature that is nearly always zero
#: in clean text may still vary a little; little enough that each feature alone can pass the cutoff of ONE_IN
FEATURES = {"word_length": 0.1, "symbols": 0.35, "repeated_lines": 0.4, "repeated_words": 0.4, "capitals": 0.3, "marks": 0.25}
#: share of a stratum that the determinant is minimised over
SHARE = 0.55
STARTS = 3
STEPS = 3
#: a stratum of fewer rows joins the rest of its language, then the rest of the corpus
MIN_ROWS = 100
#: a document is rejected if one so far out is expected once in this many of a clean stratum
ONE_IN = 1e9


def _chi2_cdf(x: float, even: int) -> float:
    return 1 - math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(even // 2))


def _chi2_quantile(upper: float, even: int) -> float:
    """The value that a chi-square variable of an even number of degrees exceeds with the probability `upper`."""
    low, high = 0.0, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        tail = 1 - _chi2_cdf(middle, even) if upper > 1e-6 else math.exp(-middle / 2) * sum(
            (middle / 2) ** j / math.factorial(j) for j in range(even // 2)
        )
        low, high = (middle, high) if tail > upper else (low, middle)
    return low


def _small(df: DataFrame) -> DataFrame:
    """A table of a few rows a stratum, written as one file, so that its size is seen to be small."""
    return settle(df.repartition(1))


def statistics(docs: DataFrame, *also: str) -> DataFrame:
    """doc_id, lang, source, the columns in `also` and the statistics of each row's whole text; null and blank texts have zeros.

    n_repeat_words: words in windows of three that the text has more than once. The windows are sorted by hash with
    their places, equal ones are neighbours then, and the places they cover are counted as a union of intervals.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    only = lambda kept: F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    n = F.size("_w")
    grams = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.struct(F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i")),
        ),
    )
    again = lambda g, k: F.coalesce(F.get("_g", k - 1)["h"] == g["h"], F.lit(False)) | F.coalesce(
        F.get("_g", k + 1)["h"] == g["h"], F.lit(False)
    )
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_p", k + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, x: a + x,
    )
    return (
        docs.select(
            "doc_id", "lang", "source", *also, words("text").alias("_w"), lines.alias("_lines"),
            F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
            only("#*$%&|<>").alias("n_symbols"), only("A-Z").alias("_capitals"), only(".,;:!?").alias("_marks"),
        )
        .withColumn("_g", F.sort_array(grams))
        .withColumn("_p", F.sort_array(F.transform(F.filter("_g", again), lambda g: g["i"])))
        .select(
            "doc_id", "lang", "source", *also, n.cast("long").alias("n_words"), "word_chars", "n_symbols",
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
            F.size("_lines").cast("long").alias("_n_lines"), "_capitals", "_marks",
        )
    )


def _features() -> dict[str, Column]:
    """The transformed statistic vector of a row, as whole numbers."""
    per = lambda a, b: F.log1p(100 * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    raw = {
        "word_length": F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
        "symbols": per("n_symbols", "n_words"),
        "repeated_lines": per("n_dup_lines", "_n_lines"),
        "repeated_words": per("n_repeat_words", "n_words"),
        "capitals": per("_capitals", "word_chars"),
        "marks": per("_marks", "n_words"),
    }
    return {k: F.round(GRAIN * v).cast("long") for k, v in raw.items()}


NAMES = list(FEATURES)


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


def _moments(rows: DataFrame, *keys: str) -> DataFrame:
    """Mean and covariance of the features per key, as columns m0.. and c00.., from exact sums of whole numbers."""
    sums = [F.sum(a).alias(f"s{i}") for i, a in enumerate(NAMES)]
    products = [F.sum((F.col(NAMES[i]) * F.col(NAMES[j])).cast("decimal(28,0)")).alias(f"q{i}{j}") for i, j in _pairs()]
    found = rows.groupBy(*keys).agg(F.count("*").cast("double").alias("n"), *sums, *products)
    mean = [(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(len(NAMES))]
    spread = [
        (F.col(f"q{i}{j}").cast("double") / F.col("n") - F.col(f"s{i}") / F.col("n") * F.col(f"s{j}") / F.col("n")).alias(f"c{i}{j}")
        for i, j in _pairs()
    ]
    return found.select(*keys, "n", *mean, *spread)


def _factored(estimates: DataFrame, factor: float) -> DataFrame:
    """Replace the covariance by the Cholesky factor of it times factor, plus the least spread of each feature."""
    out = estimates
    for i, j in _pairs():
        least = (GRAIN * FEATURES[NAMES[i]]) ** 2 if i == j else 0.0
        rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"c{i}{j}") * factor + least)
        # rounding may leave a variance that is the least one just below it
        value = F.sqrt(F.greatest(rest, F.lit(least / 4))) if i == j else rest / F.col(f"l{j}{j}")
        out = out.withColumn(f"l{i}{j}", value)
    size = reduce(lambda a, i: a + F.log(F.col(f"l{i}{i}")), range(len(NAMES)), F.lit(0.0))
    return out.withColumn("log_size", size).drop(*[f"c{i}{j}" for i, j in _pairs()])


def _distances(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Add the squared Mahalanobis distance d2 of each row from each estimate of its stratum."""
    out = rows.join(estimates, "stratum", how)
    for i, name in enumerate(NAMES):
        rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"z{k}"), range(i), F.col(name) - F.col(f"m{i}"))
        out = out.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    square = reduce(lambda a, i: a + F.col(f"z{i}") * F.col(f"z{i}"), range(len(NAMES)), F.lit(0.0))
    return out.withColumn("d2", square).drop(*[f"z{i}" for i in range(len(NAMES))])


def _strata(rows: DataFrame, min_rows: int) -> DataFrame:
    """Per (lang, source) the stratum that judges it, and those whose estimates its rows enter (feeds).

    A source of a language is a stratum; with too few rows it joins the other such ones of its language, and where these
    are too few together it is judged by the whole language. A language of too few rows joins other such languages, and
    where these are too few it is judged by all rows.
    """
    counted = _small(rows.groupBy("lang", "source").count())
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    small = F.col("count") < min_rows
    per_lang = counted.groupBy(F.col("lang").alias("_lang")).agg(
        F.sum(F.when(small, F.col("count")).otherwise(0)).alias("_rest"), F.sum("count").alias("_whole"))
    few = per_lang.agg(F.sum(F.when(F.col("_whole") < min_rows, F.col("_whole")))).scalar()
    placed = _small(
        counted.join(per_lang, F.expr("lang <=> _lang"))
        .withColumn("stratum", F.when(~small, F.concat(name("lang"), F.lit("\n"), name("source")))
                    .when(F.col("_rest") >= min_rows, name("lang"))
                    .when(F.col("_whole") >= min_rows, F.concat(F.lit("*"), name("lang")))
                    .when(few >= min_rows, "").otherwise("*"))
        .select("lang", "source", "stratum")
    )
    langs = placed.filter("stratum like '*_%'").select(F.col("stratum").alias("_needed")).distinct()
    everything = F.coalesce(placed.agg(F.max((F.col("stratum") == "*").cast("int"))).scalar() == 1, F.lit(False))
    own = F.when(~F.col("stratum").startswith("*"), F.col("stratum"))
    return (
        placed.join(langs, F.concat(F.lit("*"), name("lang")) == F.col("_needed"), "left")
        .select("lang", "source", "stratum", F.array_compact(F.array(own, F.col("_needed"), F.when(everything, F.lit("*")))).alias("feeds"))
    )


def robust_estimates(rows: DataFrame, share=SHARE, starts=STARTS, steps=STEPS, min_rows=MIN_ROWS) -> DataFrame:
    """Per stratum: mean, Cholesky factor of the covariance, from rows of stratum, draw (a hash) and the features.

    Concentration from several starts at once: the first is made of medians and quartiles, each other one of about 64
    rows that a hash picks from the whole stratum. A step takes the rows nearest to the estimate, `share` of the
    stratum in whole cells of distance, and estimates anew. The smallest determinant wins and is reweighted: mean and
    covariance of the rows within its 97.5 % ellipsoid. Strata under min_rows give no estimate.
    """
    d = len(NAMES)
    cut = _chi2_quantile(1 - share, d)
    factor = share / _chi2_cdf(cut, d + 2)
    quartiles = [F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"p{i}") for i, c in enumerate(NAMES)]
    counted = rows.groupBy("stratum").agg(F.count("*").alias("_n"), *quartiles).filter(F.col("_n") >= min_rows)
    counted = _small(counted)
    middle = counted.select(
        "stratum", F.lit(0).alias("start"), F.col("_n").cast("double").alias("n"),
        *[F.col(f"p{i}")[1].alias(f"m{i}") for i in range(d)],
        *[F.pow((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349, F.lit(2.0)).alias(f"c{i}{j}") if i == j
          else F.lit(0.0).alias(f"c{i}{j}") for i, j in _pairs()],
    )
    drawn = (
        rows.join(counted.select("stratum", F.greatest(F.floor(F.col("_n") / 64), F.lit(1)).alias("_slices")), "stratum")
        .withColumn("start", F.pmod("draw", F.col("_slices")).cast("int") + 1)
        .filter(F.col("start") < starts)
    )
    current = _small(_factored(middle.unionByName(_moments(drawn, "stratum", "start")), 1.0))
    for _ in range(steps):
        cells = _distances(rows, current).withColumn("cell", F.floor(16 * F.log(F.col("d2") + 1e-6)))
        edges = cells.groupBy("stratum", "start").agg(
            F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY cell)").alias("edge")
        )
        nearest = cells.select("stratum", "start", "cell", *NAMES).join(_small(edges), ["stratum", "start"]).filter("cell <= edge")
        current = _small(_factored(_moments(nearest, "stratum", "start"), factor))
    best = current.groupBy("stratum").agg(F.min_by("start", F.struct("log_size", "start")).alias("start"))
    best = _small(current.join(best, ["stratum", "start"]))
    inside = _distances(rows, best).filter(F.col("d2") <= _chi2_quantile(0.025, d))
    return _small(_factored(_moments(inside, "stratum"), 0.975 / _chi2_cdf(_chi2_quantile(0.025, d), d + 2)))


def judge(docs: DataFrame, one_in: float = ONE_IN, also: tuple[str, ...] = (), **settings) -> DataFrame:
    """Per row of docs (doc_id, text, lang, source): the statistics, base_failed, distance, kept.

    base_failed: fewer than MIN_WORDS words, or over MAX_REPEATED percent of them in repeated windows. Of the others,
    a document goes if its squared robust distance exceeds that of one clean document in `one_in`. Estimates come from
    all documents that pass the base rules. A null language or source is a value of its own. A source of few documents is
    judged with others of its language, else by the language; a language of few with other such ones, else by all
    documents (see _strata). If all documents together are under min_rows, nothing more is rejected. Rows that repeat are
    judged each. No rows give no rows.
    """
    measured = settle(statistics(docs, *also))
    measured = measured.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
    )
    vectors = (
        measured.filter(~F.col("base_failed"))
        .withColumns(_features())
        .withColumn("draw", F.xxhash64("doc_id", *NAMES))
        .select("doc_id", "lang", "source", "draw", *NAMES)
    )
    strata = _small(_strata(vectors, settings.get("min_rows", MIN_ROWS)))
    key = F.expr("v.lang <=> s.lang and v.source <=> s.source")
    located = settle(vectors.alias("v").join(strata.alias("s"), key).select(F.explode("feeds").alias("stratum"), "draw", *NAMES))
    estimates = robust_estimates(located, **settings).withColumnRenamed("n", "_inside")
    placed = (
        measured.withColumns(_features()).alias("v").join(strata.alias("s"), key, "left")
        .select("v.*", F.coalesce("stratum", F.lit("*")).alias("stratum"))
    )
    return (
        _distances(placed, estimates, "left")
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= _chi2_quantile(1 / one_in, len(NAMES)), F.lit(True)))
        .select("doc_id", "lang", "source", *also, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed", F.sqrt("d2").alias("distance"), "kept")
    )


def kept_documents(docs: DataFrame, **settings) -> DataFrame:
    """All rows and columns of docs but for the documents that `judge` rejects."""
    text = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    verdicts = judge(docs.select("doc_id", "text", "lang", "source", text.alias("_text")), also=("_text",), **settings)
    rejected = verdicts.filter("not kept").select(F.col("doc_id").alias("_id"), "_text").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", text.alias("_hash"))
    return rows.join(rejected, F.expr("doc_id <=> _id and _hash = _text"), "left_anti").select("row.*")
