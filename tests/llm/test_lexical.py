import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelkit.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    """The contract, document by document."""
    counted = [(i, Counter(split(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(split(text)) if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if null else doc, -s) for rank, (s, null, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def corpus(n=150, seed=2):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Über", "日本", "a_b", "C3PO", "x\x85y", "straße"]
    texts = [" ".join(draw.choices(words, k=draw.choice([1, 3, 8, 40]))) for _ in range(n)]
    docs = [(draw.choice([None, i, i // 3]), t) for i, t in enumerate(texts)]
    docs += [(1000 + i, "tie " * 3) for i in range(25)] + [(5, None), (6, ""), (7, " .-! "), (8, "w1 " * 30_000)]
    items = [(i, " ".join(draw.choices(words + ["unknown"], k=12))) for i in range(9)]
    items += [(3, "tie"), (3, "tie"), (None, "w1 w2"), (20, None), (21, ""), (22, "nowhere"), (23, "TIE w1")]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"tile_docs": 7, "block_items": 2, "slice_": 3, "columns": 2}, {"broadcast_bytes": 0, "tile_docs": 5, "block_terms": 20}])
def test_brute_force(sizes, spark):
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("rank", "score", "item", "terms")})
    assert found(lexical.search(d.withColumns({c: F.lit(1) for c in ("tile", "n", "words", "w")}), i, **sizes)) == brute(docs, items)


def test_terms():
    for text in ["Ab-c3 ÜBER_straße\x85ſ", "日本語 KK", "\x00a\x7fb\ncd", "", None, "[^]`{}~@/:"]:
        assert [t.decode() for t in lexical.terms(text)] == split(text)


def test_sums_that_would_exceed_doubles_are_cut(spark, monkeypatch):
    """With a small bound every slice holds few terms; scores stay the same."""
    docs, items = corpus(40, 9)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items)
    rows = lexical._tiles(d, 2048, 1 << 20).collect()
    assert sum(r.n_docs for r in rows) == sum(bool(split(t)) for _, t in docs)
    tile = {**rows[0].asDict()}
    block = {"rows": [0], "item_ids": [0], "vocabulary": ["w1", "w2", "w3"], "weights": lexical.np.array([5000, 4000, 3000]).tobytes(),
             "entries": lexical.np.array([3]).tobytes(), "members": lexical.np.array([0, 1, 2], "int32").tobytes()}
    whole = list(lexical._meet(block, tile, 40, 400, 10, 4096, 512))
    monkeypatch.setattr(lexical, "EXACT", 5000 * 1_000_000 + 1)
    assert list(lexical._meet(block, tile, 40, 400, 10, 4096, 512)) == whole and whole
    assert found(lexical.search(d, i)) == expected


def test_nothing(spark, empty):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(empty, items).collect() == []
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lexical.search(docs, items.filter("item_id < 0")).collect() == []
    assert lexical.search(docs, spark.createDataFrame([(1, None)], "item_id long, text string")).collect() == []
    assert [tuple(r) for r in lexical.search(docs, items).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]
