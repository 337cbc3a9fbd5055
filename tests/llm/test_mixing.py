from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelkit.llm import mixing
from panelkit.llm.text import table


def _water(sizes, weights, cap):
    """Targets by handing on the excess again and again."""
    targets, open_ = {}, dict(sizes)
    left = float(sum(sizes.values()))
    while open_:
        total = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / total > cap * sizes[s]]
        if not over:
            targets.update({s: left * weights[s] / total for s in open_})
            break
        for s in over:
            targets[s] = cap * sizes[s]
            left -= cap * sizes[s]
            del open_[s]
    return targets


@pytest.mark.parametrize("sizes", [[100, 5, 900, 30, 0, 2], [7], [0, 0], [10, 1000, 10]])
def test_targets(spark, sizes):
    names = ["a", "b", "c", "é", "日", None][: len(sizes)]
    rows = mixing.targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()
    weights = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    expected = _water(dict(zip(names, sizes)), weights, 3)
    assert {r.source: round(r.target, 6) for r in rows} == {n: round(t, 6) for n, t in expected.items()}


@pytest.mark.parametrize("votes,seats", [([10.0, 20.0, 30.0], 7), ([1.0, 1.0, 1.0, 1.0], 2), ([0.0, 5.0], 3), ([1000.0, 1.0, 1.0, 1.0, 1.0, 1.0], 4),
                                         ([53.0, 24.0, 23.0], 1001), ([3.0, 3.0], 0), ([0.0], 5)])
def test_highest_quotients(spark, votes, seats):
    parties = spark.createDataFrame([(f"p{i}", v, seats) for i, v in enumerate(votes)], "name string, votes double, seats long")
    own = {r.name: r.won for r in mixing.apportion(parties, "name", "votes", "seats").select(F.col("name"), "won").collect()}
    won = defaultdict(int)
    for _ in range(seats if any(votes) else 0):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[f"p{i}"] + 1), -i))
        won[f"p{best}"] += 1
    assert own == {f"p{i}": won[f"p{i}"] for i in range(len(votes))}


def test_edges(spark, edge, empty):
    assert mixing.mix(empty).count() == 0 and mixing.mixed_texts(empty).count() == 0
    rows = mixing.mix(edge, block_words=4, shard_documents=2).collect()
    again = mixing.mix(edge.repartition(7), block_words=4, shard_documents=2).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == edge.count()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    for r in rows:
        assert r.source_size == sizes[r.source]
    for s in sizes:
        assert target[s] <= 3 * sizes[s] and abs(taken[s] - target[s]) <= 4 * 4
    mixed = mixing.mixed_texts(edge, block_words=4, shard_documents=2)
    assert mixed.columns == edge.columns


def test_mixed_texts_are_the_words_selected(spark):
    """Against the repeated stream of words of a single shard; two rows share an id and a size."""
    rows = [(min(i, 11), "\n ".join(f"d{i}w{k}" + (" \t" if k % 3 else "") for k in range(10 + 7 * min(i, 11))) + "\n", f"s{min(i, 11) % 2}") for i in range(13)]
    rows.append((99, " \n", "s0"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    settings = {"block_words": 4, "shard_documents": 100}
    plan = mixing.mix(docs, **settings).collect()
    mixed = [r.text for r in mixing.mixed_texts(docs, **settings).collect()]
    assert " \n" in mixed and sum(len(t.split()) for t in mixed) == sum(r.taken for r in plan)
    texts = {t.split()[0]: t for _, t, _ in rows if t.split()}
    parts = [t for t in mixed if t.strip() and t not in texts.values()]
    assert parts and all(any(t in whole for whole in texts.values()) for t in parts)  # as they stand there, blanks too
    assert any(t.split()[0] not in texts for t in parts)  # the run starts within a document
    counts = defaultdict(int)
    for t in mixed:
        for w in t.split():
            counts[w] += 1
    for source in ("s0", "s1"):
        # a run of the stream: counts of neighbouring words differ at its start and its end only
        own = [t.split() for _, t, s in rows if s == source and t.split()]
        changes = sum(counts[a] != counts[b] for ws in own for a, b in zip(ws, ws[1:]))
        assert changes <= 2
