import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from panelkit.llm import hidden
from panelkit.llm.text import table


def _model(seed, words=5, states=3):
    rng = np.random.RandomState(seed)
    return hidden._normalised(rng.rand(states + 1, states + 1) + 0.05, rng.rand(words + 1, states) + 0.05)


def _paths(model, text):
    """Every path of states through a text and its end, with its probability."""
    states, end = len(model.transitions), len(model.emissions) - 1
    sequence = [*text, end]
    for path in itertools.product(range(states), repeat=len(sequence)):
        p, last = 1.0, states - 1
        for s, w in zip(path, sequence):
            p *= model.transitions[last, s] * model.emissions[w, s]
            last = s
        if p:
            yield path, sequence, p


@pytest.mark.parametrize("lanes,block", [(512, 256), (2, 2), (1, 3)])
def test_likelihood_and_counts_match_all_paths(monkeypatch, lanes, block):
    monkeypatch.setattr(hidden, "LANES", lanes)
    monkeypatch.setattr(hidden, "BLOCK", block)
    model, rng = _model(1), np.random.RandomState(2)
    texts = [rng.randint(0, 6, n).astype(np.int32) for n in (0, 1, 4, 2, 0, 3, 5)]
    emitted, moved = np.zeros((len(model.emissions), 4)), np.zeros((4, 4))
    model.expect(texts, emitted, moved)
    all_emitted, all_moved, logs = np.zeros_like(emitted), np.zeros_like(moved), []
    for text in texts:
        paths = list(_paths(model, text))
        total = sum(p for _, _, p in paths)
        logs.append(math.log10(total))
        for path, sequence, p in paths:
            last = 3
            for s, w in zip(path, sequence):
                all_emitted[w, s] += (p / total) * (s < 3)
                all_moved[last, s] += p / total
                last = s
    assert np.allclose(model.log10(texts), logs)
    assert np.allclose(emitted[:-1], all_emitted[:-1]) and np.allclose(moved, all_moved)


def test_training_raises_likelihood_and_beats_the_base_on_held_out_documents(spark, sf):
    docs = table(spark, sf, "documents")
    sums = []
    for iterations in (1, 4):
        rows = hidden.score(docs, head=3000, states=4, iterations=iterations).collect()
        sums.append(sum(r.score for r in rows if not r.held_out))
    assert sums[1] > sums[0]
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("head", [5, 1000])
def test_base_and_edges(spark, edge, head):
    rows = hidden.score(edge, head=head, states=2, iterations=2).collect()
    texts = [(r.doc_id, (r.text or "").encode().lower().split() + [b""]) for r in edge.collect()]
    counts = Counter()
    for i, words in texts:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (str(i), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6)) for i, w in texts)
    assert expected == sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert all(r.score < 0 for r in rows)


def test_empty_and_nothing_to_learn_from(spark, empty):
    assert hidden.score(empty, head=10, states=2, iterations=1).count() == 0
    held = next(i for i in range(100) if hidden.is_held_out(i))
    row = hidden.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string"), head=10, states=2, iterations=1).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and math.isfinite(row.score)
