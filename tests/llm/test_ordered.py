from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import ordered
from panelkit.llm.text import table


def _classes(rows):
    """Smallest id of what the similar pairs among all pairs connect."""
    texts = [ordered.Text(i, ordered.tokens((t or "").encode())) for i, (_, t) in enumerate(rows)]
    root = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if rows[i][1] == rows[j][1] or ordered.similar(texts[i], texts[j]):
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min(x for x in (least.get(r), i) if x is not None) if (least.get(r), i) != (None, None) else None
    return sorted((str(i), str(least[r])) for (i, _), r in zip(rows, root))


def _shuffled(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randint(len(words))
        words[at:at + 1] = [["new", "word"], [], [f"w{rng.randint(999)}"]][rng.randint(3)]
    return words


@pytest.fixture(scope="module")
def groups(spark):
    rng = np.random.RandomState(6)
    rows, n = [], 0
    for size, length in ((40, 120), (3, 60), (8, 300), (1, 3), (2, 3), (5, 1000)):
        base = [f"v{rng.randint(4000)}" for _ in range(length)]
        for k in range(size):
            rows.append((n, " ".join(_shuffled(rng, base, rng.randint(max(length // 25, 2))) if k else base)))
            n += 1
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(n + k, " ".join(f"v{rng.randint(4000)}" for _ in range(50)) + " " + passage) for k in range(30)]
    return rows


@pytest.mark.parametrize("block,few", [(1024, 12), (7, 0), (5, 100)])
def test_classes_match_all_pairs(spark, groups, monkeypatch, block, few):
    monkeypatch.setattr(ordered, "BLOCK", block)
    docs = spark.createDataFrame(groups, "doc_id long, text string").repartition(4)
    if few != 12:
        monkeypatch.setattr(ordered, "FEW", few)
    own = sorted((str(r.doc_id), str(r.class_id)) for r in ordered.deduplicated(docs).collect())
    assert own == _classes(groups)


def test_alignment_matches_dynamic_programming():
    rng = np.random.RandomState(7)
    for _ in range(60):
        base = [str(rng.randint(30)) for _ in range(rng.randint(1, 60))]
        other = _shuffled(rng, base, rng.randint(3))
        if rng.rand() < 0.3:
            cut = rng.randint(len(other) + 1)
            other = other[cut:] + other[:cut]
        a, b = (ordered.shingles(ordered.tokens(" ".join(w).encode())) for w in (base, other))
        longest = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                longest[i + 1, j + 1] = longest[i, j] + 1 if a[i] == b[j] else max(longest[i, j + 1], longest[i + 1, j])
        common = longest[-1, -1]
        expected = common >= 0.8 * (len(a) + len(b) - common) - 1e-9
        assert ordered.similar(ordered.Text(0, ordered.tokens(" ".join(base).encode())), ordered.Text(1, ordered.tokens(" ".join(other).encode()))) == expected


def test_sketches_share_as_often_as_shingles():
    rng = np.random.RandomState(8)
    missed = 0
    for _ in range(300):
        base = [f"v{rng.randint(10**6)}" for _ in range(150)]
        other = list(base)
        other[rng.randint(150)] = other[rng.randint(150)] = "changed"
        a, b = (ordered.sketches(ordered.shingles(ordered.tokens(" ".join(w).encode()))) for w in (base, other))
        missed += not (a == b).any()
    assert missed == 0
    a, b = base, base[75:] + base[:75]  # the same shingles in another order
    a, b = (ordered.sketches(ordered.shingles(ordered.tokens(" ".join(w).encode()))) for w in (a, b))
    assert (a == b).mean() < 0.4


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (9, 8), (7, 8), (5, 5), (20, 21)] + [(100, 100 + i) for i in range(1, 60)] + [(i, i + 1) for i in range(200, 260)]
    rows = ordered.connected(spark.createDataFrame(links, "a long, b long")).collect()
    own = {r.node: r.root for r in rows}
    assert own == {2: 1, 3: 1, 4: 1, 8: 7, 9: 7, 21: 20, **{100 + i: 100 for i in range(1, 60)}, **{i + 1: 200 for i in range(200, 260)}}


def test_edges(spark, edge, empty, sf):
    assert ordered.deduplicated(empty).count() == 0 and ordered.one_of_each(empty).count() == 0
    rows = [(r.doc_id, r.text or "") for r in edge.collect()]
    own = sorted((str(r.doc_id), str(r.class_id)) for r in ordered.deduplicated(edge).collect())
    assert own == _classes(rows)
    kept = ordered.one_of_each(edge)
    assert kept.columns == edge.columns
    found = sorted(str(r.doc_id) for r in kept.collect())
    assert found == sorted({c for _, c in own})
    docs = table(spark, sf, "documents")
    assert ordered.one_of_each(docs).count() == ordered.deduplicated(docs).agg(F.countDistinct("class_id")).first()[0]


def test_short_texts_always_meet():
    """Whatever two similar texts, one of them short, their buckets have one in common."""
    rng = np.random.RandomState(9)
    seen = 0
    for _ in range(6000):
        base = [f"v{rng.randint(50)}" for _ in range(rng.randint(4, 36))]
        other = _shuffled(rng, base, rng.randint(1, 3))
        if rng.rand() < 0.5:  # words before or after
            other = [f"w{rng.randint(99)}"] * rng.randint(2) + base + [f"w{rng.randint(99)}" for _ in range(rng.randint(6))]
        a, b = (ordered.Text(n, ordered.tokens(" ".join(w).encode())) for n, w in enumerate((base, other)))
        if min(len(a), len(b)) > ordered.SHORT or not ordered.similar(a, b):
            continue
        met = [set(ordered.meetings(ordered.shingles(ordered.tokens(" ".join(w).encode()))).tolist()) for w in (base, other)]
        assert met[0] & met[1]
        seen += len(a) != len(b) or (a.sorted != b.sorted).any()
    assert seen > 500


def test_recall_by_length(spark):
    """All links among texts of 5 to 60 words, each with copies just at the least similarity."""
    rng, rows = np.random.RandomState(10), []
    for n, length in enumerate([*range(5, 45), *range(45, 61, 5)] * 2):
        base = [f"g{n}x{k}" for k in range(length)]
        for extra in (0, max(1, (length - 4) // 4), 1):
            rows.append((len(rows), " ".join(base + [f"e{rng.randint(10**6)}" for _ in range(extra)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    own = sorted((str(r.doc_id), str(r.class_id)) for r in ordered.deduplicated(docs).collect())
    expected = _classes(rows)
    short = {str(i) for i, t in rows if len(t.split()) - 4 <= ordered.SHORT}
    assert [r for r in own if r[0] in short] == [r for r in expected if r[0] in short]
    assert sum(a == b for a, b in zip(own, expected)) >= 0.99 * len(rows)
