import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelkit.llm import vafile

SCHEMA = "vec_id long, embedding array<float>"


def _brute(rows, k):
    usable = []
    for n, (i, v) in enumerate(rows):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((n, i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = []
    for n, i, q in usable:
        if i is not None and i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0, m) for m, j, v in usable if m != n)[:k]
            out += [(i, rank, None if none else j, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, none, j, _) in enumerate(scored, 1)]
    return sorted(out, key=str)


def _search(spark, rows, k=20):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("q", F.lit(0)).repartition(3)
    return sorted(map(tuple, vafile.search(df, F.col("vec_id") % 20 == 0, k).collect()), key=str)


@pytest.mark.parametrize("cells,blocks", [(64, (16_384, 1024, 256)), (4, (50, 7, 3)), (2, (1000, 1000, 2))])
def test_matches_all_pairs(spark, monkeypatch, cells, blocks):
    monkeypatch.setattr(vafile, "CELLS", cells)
    for name, value in zip(("VECTOR_BLOCK", "QUERY_BLOCK", "QUERY_SLICE"), blocks):
        monkeypatch.setattr(vafile, name, value)
    rng = np.random.RandomState(1)
    rows = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 360)]  # many equal vectors
    rows += [(400, rows[3][1]), (400, rows[3][1]), (40, rows[5][1])]  # ids that repeat
    rows += [(500, None), (520, [None] * 8), (540, [float("nan")] * 8), (560, [float("inf")] + [0.0] * 7), (None, rows[1][1]), (580, [])]
    rows += [(600, [1.5, -2.0]), (601, [1e6] * 8)]  # a short one and a long one
    assert _search(spark, rows, 20) == _brute(rows, 20)


def test_few_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (20, [3.0, -1.0])]
    assert _search(spark, rows) == _brute(rows, 20) and len(_brute(rows, 20)) == 4
    assert _search(spark, [(0, [1.0])]) == [] and _search(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert vafile.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_long_vectors_and_rows_without_id(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e9, 1.0]), (2, [-1e9, 3.0]), (20, [1e9, -1e9]), (None, [1e9, 1.0]), (40, [2.0**40, 2.0**41]), (3, [2.0**40, 2.0**41])]
    rows += [(60, [2.0**30 + 1, 7.0]), (4, [2.0**31, -(2.0**32)])]
    assert _search(spark, rows, 4) == _brute(rows, 4)
    assert any(r[2] is None for r in _search(spark, rows, 20))
    far = [(0, [1e30, 1.0]), (1, [1e30, -5.0]), (2, [-1e30, 0.0]), (3, [0.5, 0.5])]
    found = _search(spark, far)
    assert [r[2] for r in sorted(found, key=lambda r: r[1])] == [1, 3, 2] and found[0][3] == 2**63 - 1


def _plans(spark, monkeypatch, rows):
    """The plans of what search writes, as they are before anything runs, with their joins."""
    plans, settle = [], vafile.settle

    def noted(df, *by):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return settle(df, *by)

    monkeypatch.setattr(vafile, "settle", noted)
    return _search(spark, rows), plans


def test_vectors_and_blocks_are_not_broadcast(spark, monkeypatch):
    rows = [(20 * i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)]
    found, plans = _plans(spark, monkeypatch, rows)
    assert found == _brute(rows, 20)
    joins = [line for p in plans if "MapInArrow" in p or "zip_with" in p for line in p.splitlines() if "Join" in line]
    vectors = [line for line in joins if "_q#" in line or "[row#" in line or "[query#" in line]
    assert len([line for line in joins if "_q#" in line]) == 1 and len(vectors) >= 3
    assert not [line for line in vectors if "Broadcast" in line]


@pytest.mark.parametrize("groups,parts,held", [((8, 64), 8, 2**20), ((2, 3), 1, 100), ((1, 1), 200, 0)])
def test_bounds_are_kept_from_block_to_block(spark, monkeypatch, groups, parts, held):
    names = "QUERY_GROUP", "VECTOR_GROUP", "VECTOR_BLOCK", "QUERY_BLOCK", "QUERY_SLICE", "VECTOR_SLICE", "HELD"
    for name, value in zip(names, (*groups, 50, 7, 3, 20, held)):
        monkeypatch.setattr(vafile, name, value)
    rng = np.random.RandomState(2)
    rows = [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(500)]
    rows += [(i, rows[20][1]) for i in range(500, 600)] + [(600, rows[20][1])] * 2
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert _search(spark, rows, 5) == _brute(rows, 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_later_blocks_pass_on_less():
    rng = np.random.RandomState(3)
    width, n, k = 8, 200, 5
    values = np.floor(64 * rng.standard_normal((20 * n, width))).astype(np.int64)
    grid = [(int(c.min()), int(c.max()), sorted({int(x) for x in np.quantile(c, np.arange(1, 64) / 64)} - {int(c.min())})) for c in values.T]
    cells, scan = vafile._bounded(grid, width, k)
    asked = values[:10]

    def meeting(at):
        part = slice(at, at + n)
        body = [asked.tobytes(), np.arange(part.start, part.stop).tobytes(), cells(values[part]).tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([0]), pa.array([0]), *(pa.array([b], pa.binary()) for b in (np.arange(10).tobytes(), *body))],
            names=["group", "first", "rows", "b1", "r2", "b2"])

    def count(found):
        return sum(len(b) for b in found)

    each = [count(scan([meeting(at)])) for at in range(0, len(values), n)]
    together = list(scan([meeting(at) for at in range(0, len(values), n)]))
    assert count(together) < sum(each) / 3
    kept = {(q, r) for b in together for q, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    scores = asked @ values.T
    for q in range(10):
        best = sorted((-int(s), r) for r, s in enumerate(scores[q]) if r != q)[:k]
        assert all((q, r) in kept for _, r in best)
