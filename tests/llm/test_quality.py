import re
from collections import Counter

import numpy as np

from panelkit.functions.durable import settle
from panelkit.llm import quality
from tests.llm.conftest import prose

BLANK = re.compile("[\x20\x09-\x0D]+")


def _base(text):
    text = text or ""
    words = [w for w in BLANK.split(text) if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if BLANK.sub("", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_base_statistics(spark, edge):
    texts = [prose(40) + "\n" + prose(40) + "\n\n \n" + prose(40), "a b a b a b a", "##|| <x>\n##|| <x>\r\n", "a b c d a b c x y z x y z"]
    more = spark.createDataFrame([(100 + i, t, "en", "z") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    docs = edge.select("doc_id", "text", "lang", "source").unionByName(more)
    rows = quality.judge(docs).collect()
    own = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert own == sorted((str(r.doc_id), *_base(r.text)) for r in docs.collect())
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)  # strata this small reject nothing more


def _corpus(spark):
    rng = np.random.RandomState(4)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.randint(2, 9))) for _ in range(500)]
    rows = []
    for i in range(600):
        words = list(rng.choice(vocabulary, 120 + i % 200))
        if i % 11 == 5:
            words = [w + "$#%" for w in words]
        elif i % 11 == 7:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words) + ".", "en" if i % 3 else None, f"s{i % 2}"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_outliers_go_and_clean_documents_stay(spark):
    rows = quality.judge(_corpus(spark), min_rows=50).collect()
    assert all(r.kept == (r.doc_id % 11 not in (5, 7)) for r in rows)
    again = quality.judge(_corpus(spark).repartition(5), min_rows=50).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_repetition_alone_goes(spark):
    """Half of the lines copies, or 45 percent of the words repeated, and nothing else out of the ordinary."""
    rng = np.random.RandomState(8)
    vocabulary = sorted({"".join(rng.choice(list("abcdefghij"), rng.randint(3, 8))) for _ in range(3000)})
    rows = []
    for i in range(300):
        words = list(rng.choice(vocabulary, 120, replace=False))
        if i % 20 == 3:
            words[93:] = words[:27]  # at an odd place, so that no line is the same
        lines = [" ".join(words[k:k + 2]) for k in range(0, 120, 2)]
        if i % 20 == 7:
            lines = lines[:30] + [lines[7 * k % 30] for k in range(30)]  # in another order, so that no window is the same
        rows.append((i, "\n".join(lines), "en", "s"))
    judged = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(judged[i].n_dup_lines == 0 and judged[i].n_repeat_words == 54 for i in range(3, 300, 20))
    assert all(judged[i].n_dup_lines == 30 and judged[i].n_repeat_words == 0 for i in range(7, 300, 20))
    assert not any(r.base_failed for r in judged.values())
    assert [i for i, r in sorted(judged.items()) if not r.kept] == sorted([*range(3, 300, 20), *range(7, 300, 20)])


def test_distances_match_numpy(spark):
    """Concentration steps, reweighting and distances done again on arrays."""
    from pyspark.sql import functions as F

    measured = quality.statistics(_corpus(spark).filter("lang is not null and source = 's0'")).withColumns(quality._features())
    table_ = settle(measured.select("doc_id", F.lit("x").alias("stratum"), F.xxhash64("doc_id", *quality.NAMES).alias("draw"), *quality.NAMES))
    estimate = quality.robust_estimates(table_, min_rows=50)
    own = {r.doc_id: r.d2 for r in quality._distances(table_, estimate).collect()}
    rows = table_.collect()
    x = np.array([[r[c] for c in quality.NAMES] for r in rows], dtype=float)
    d, floor = x.shape[1], np.diag([(quality.GRAIN * v) ** 2 for v in quality.FEATURES.values()])
    cut = quality._chi2_quantile(1 - quality.SHARE, d)

    def distance(mean, cov, factor):
        z = np.linalg.solve(np.linalg.cholesky(cov * factor + floor), (x - mean).T)
        return (z * z).sum(axis=0), np.log(np.linalg.det(cov * factor + floor))

    def moments(some):
        return some.mean(axis=0), np.cov(some.T, bias=True)

    low, middle, high = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    starts = [(middle, np.diag(((high - low) / 1.349) ** 2))]
    slices = max(len(x) // 64, 1)
    starts += [moments(x[[r.draw % slices == k for r in rows]]) for k in range(2) if k < slices]
    best = None
    for mean, cov in starts:
        factor = 1.0
        for _ in range(quality.STEPS):
            far, _ = distance(mean, cov, factor)
            cell = np.floor(16 * np.log(far + 1e-6))
            edge = np.sort(cell)[int(np.ceil(quality.SHARE * len(x))) - 1]
            mean, cov = moments(x[cell <= edge])
            factor = quality.SHARE / quality._chi2_cdf(cut, d + 2)
        far, size = distance(mean, cov, factor)
        if best is None or size < best[0]:
            best = size, far
    inside = quality._chi2_quantile(0.025, d)
    mean, cov = moments(x[best[1] <= inside])
    far, _ = distance(mean, cov, 0.975 / quality._chi2_cdf(inside, d + 2))
    assert np.allclose([own[r.doc_id] for r in rows], far, rtol=1e-6)


def test_chi_square():
    assert abs(quality._chi2_quantile(0.05, 2) - 5.9915) < 1e-3 and abs(quality._chi2_quantile(0.025, 6) - 14.4494) < 1e-3


def test_empty_and_kept_documents(spark, edge, empty):
    assert quality.judge(empty).count() == 0
    kept = quality.kept_documents(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in edge.collect() if _base(r.text)[0] >= 50 and r.doc_id != 5) + (
        ["5"] if 100 * _base(next(r.text for r in edge.collect() if r.doc_id == 5))[4] <= 50 * 30_000 else [])


def test_few_documents_of_a_language_are_judged_by_all(spark):
    """300 documents of one language and 90 of another, 40 of these junk; and a source of few of the first language."""
    rng = np.random.RandomState(4)
    vocabulary = sorted({"".join(rng.choice(list("abcdefghij"), rng.randint(3, 8))) for _ in range(3000)})

    def text(junk):
        words = list(rng.choice(vocabulary, 150, replace=False))
        return " ".join(w + "#$%" * 8 if junk and i % 2 else w for i, w in enumerate(words))

    rows = [(i, text(False), "en", "s") for i in range(300)]
    rows += [(1000 + i, text(i < 40), "xx", "s") for i in range(90)]
    rows += [(2000 + i, text(i < 3), "en", "t") for i in range(30)]
    judged = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    gone = {r.doc_id for r in judged if not r.kept}
    assert gone == {*range(1000, 1040), *range(2000, 2003)}
    assert all(r.distance is not None for r in judged)


def test_strata(spark):
    sizes = {("en", "a"): 200, ("en", "b"): 30, ("de", "a"): 60, ("de", "b"): 70, ("fr", "a"): 40, (None, None): 50}
    rows = [(g, s) for (g, s), n in sizes.items() for _ in range(n)]
    found = {(r.lang, r.source): (r.stratum, sorted(r.feeds)) for r in quality._strata(spark.createDataFrame(rows, "lang string, source string"), 100).collect()}
    assert found == {
        ("en", "a"): ("=en\n=a", ["*", "*=en", "=en\n=a"]), ("en", "b"): ("*=en", ["*", "*=en"]),
        ("de", "a"): ("=de", ["*", "=de"]), ("de", "b"): ("=de", ["*", "=de"]),
        ("fr", "a"): ("*", ["*"]), (None, None): ("*", ["*"]),
    }
