import math
import random

import pytest

from panelkit.operators import clusters


def _brute(points, eps, min_points):
    """Textbook density clustering over all pairs; a border point takes the lowest-numbered cluster."""
    near = {
        i: [j for j, (x, y) in points.items() if (points[i][0] - x) ** 2 + (points[i][1] - y) ** 2 <= eps * eps]
        for i in points
    }
    core = {i for i in points if len(near[i]) >= min_points}
    cluster, k = {}, 0
    for start in sorted(core):
        if start in cluster:
            continue
        k += 1
        stack = [start]
        while stack:
            i = stack.pop()
            if i in cluster:
                continue
            cluster[i] = k
            stack += [j for j in near[i] if j in core]
    for i in points:
        if i not in core:
            cluster[i] = min((cluster[j] for j in near[i] if j in core), default=0)
    return core, cluster


def _blobs(seed, n):
    rng = random.Random(seed)
    centres = [(0, 0), (1.2, 0.3), (4, 4), (4.9, 4.2)]
    out = {}
    for i in range(n):
        cx, cy = rng.choice(centres)
        out[i] = (cx + rng.gauss(0, 0.35), cy + rng.gauss(0, 0.35))
    for i in range(n, n + n // 5):
        out[i] = (rng.uniform(-2, 7), rng.uniform(-2, 7))
    return out


def _frame(spark, points):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in points.items()], "id int, x double, y double")


@pytest.mark.parametrize("seed,n,eps,min_points", [(1, 250, 0.2, 5), (2, 400, 0.3, 20)])
def test_same_as_all_pairs(spark, seed, n, eps, min_points):
    points = _blobs(seed, n)
    core, cluster = _brute(points, eps, min_points)
    got = clusters.density_clusters(_frame(spark, points), eps, min_points).collect()
    assert {r["id"] for r in got if r["core"]} == core
    assert {r["id"]: r["cluster"] for r in got} == cluster
    flags = clusters.density_core(_frame(spark, points), eps, min_points).collect()
    assert {r["id"] for r in flags if r["core"]} == core and len(flags) == len(points)


def test_most_points_on_one_spot(spark):
    points = {i: (0.5, 0.5) for i in range(500)}
    points |= {500 + i: (0.5 + 0.1 * i, 0.5) for i in range(1, 10)} | {600: (9.0, 9.0)}
    _, cluster = _brute(points, 0.15, 4)
    got = clusters.density_clusters(_frame(spark, points), 0.15, 4).collect()
    assert {r["id"]: r["cluster"] for r in got} == cluster


def test_close_cells_need_not_be_linked(spark):
    """Two thick columns whose nearest points are just apart, then just together."""
    for shift, clusters_found in ((1.01, 2), (0.99, 1)):
        points = {i: (0.0, i / 40) for i in range(20)} | {100 + i: (shift, i / 40) for i in range(20)}
        got = clusters.density_clusters(_frame(spark, points), 1.0, 5).collect()
        assert len({r["cluster"] for r in got}) == clusters_found


def test_components_of_a_long_path(spark):
    rng = random.Random(4)
    names = list(range(200))
    rng.shuffle(names)
    edges = spark.createDataFrame([(a, b) for a, b in zip(names, names[1:]) if a != names[99]], "a int, b int")
    nodes = spark.createDataFrame([(n,) for n in names], "node int")
    got = {r["node"]: r["label"] for r in clusters.components(edges, nodes).collect()}
    left, right = names[:100], names[100:]
    assert all(got[n] == min(left) for n in left) and all(got[n] == min(right) for n in right)


def test_standardize(spark):
    df = spark.createDataFrame([(1, 1.0, 7.0), (2, 3.0, 7.0)], "id int, a double, b double")
    got = {r["id"]: (r["a"], r["b"]) for r in clusters.standardize(df, ["a", "b"]).collect()}
    assert got[1] == (pytest.approx(-1 / math.sqrt(2)), None) and got[2][0] == pytest.approx(1 / math.sqrt(2))


def test_projection_finds_the_long_axis(spark):
    rng = random.Random(5)
    rows = [(i, [t + rng.gauss(0, 0.01), 2 * t, rng.gauss(0, 0.01)]) for i, t in enumerate(rng.gauss(0, 1) for _ in range(200))]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    out = clusters.pca_project(df, "v", 2, standard=False).collect()
    spread = [sum(r[c] ** 2 for r in out) for c in ("pc1", "pc2")]
    assert spread[0] > 1000 * spread[1]


def test_contingency_and_histogram(spark):
    df = spark.createDataFrame([(1, "a", 0.1), (1, "b", 0.9), (2, "a", -5.0)], "k int, c string, v double")
    got = {r["k"]: (r["a"], r["b"]) for r in clusters.contingency(df, "k", "c", ["a", "b"]).collect()}
    assert got == {1: (1, 1), 2: (1, 0)}
    bins = {(r["k"], r["bin"]): r["n"] for r in clusters.axis_histogram(df, "v", "k", 0.0, 1.0, 2).collect()}
    assert bins == {(1, 1): 1, (1, 2): 1, (2, 0): 1}


def test_points_without_a_place_are_noise(spark):
    points = [(i, 0.1 * i, 0.0) for i in range(10)] + [(20, None, 0.0), (21, 0.0, float("nan")), (22, float("inf"), 0.0)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = {r["id"]: (r["core"], r["cluster"]) for r in clusters.density_clusters(df, 0.5, 3).collect()}
    assert len(got) == 13 and all(got[i] == (0, 0) for i in (20, 21, 22)) and all(got[i] == (1, 1) for i in range(10))
    assert {r["id"]: r["core"] for r in clusters.density_core(df, 0.5, 3).collect()} == {i: c for i, (c, _) in got.items()}


def test_projection_has_one_sign(spark):
    rng = random.Random(6)
    rows = [(i, [-t, -2 * t + rng.gauss(0, 0.01)]) for i, t in enumerate(rng.gauss(0, 1) for _ in range(50))]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    assert all((r["pc1"] > 0) == (r["v"][1] > 0) for r in clusters.pca_project(df, "v", 1, standard=False).collect() if abs(r["v"][1]) > 0.1)
