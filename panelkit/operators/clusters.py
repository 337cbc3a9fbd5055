"""Standardising, projecting and density clustering of customers."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.columns import replace_columns
from panelkit.functions.durable import settle
from panelkit.functions.running import running


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """z-scores over the whole table; a constant column becomes null."""
    moments = [F.avg(c).alias(f"{c}_mean") for c in columns] + [F.stddev_samp(c).alias(f"{c}_std") for c in columns]
    s = df.agg(F.struct(*moments)).scalar()
    return replace_columns(df, {c: F.try_divide(F.col(c) - s[f"{c}_mean"], s[f"{c}_std"]) for c in columns})


def pca_project(df: DataFrame, vector: str, k: int = 2, standard: bool = True) -> DataFrame:
    """First k principal components of an array column as pc1, pc2, ...

    The covariance is summed across the executors; only its k vectors reach the driver.
    A component's sign is free; the one that makes its largest loading positive is taken.
    """
    rows = df.withColumn("_vector", array_to_vector(F.col(vector).cast("array<double>")))
    source = "_vector"
    if standard:
        source = "_scaled"
        scaler = StandardScaler(withMean=True, withStd=True, inputCol="_vector", outputCol=source)
        rows = scaler.fit(rows).transform(rows)
    model = PCA(k=k, inputCol=source, outputCol="_pc").fit(rows)
    parts = vector_to_array("_pc")
    loadings = model.pc.toArray()
    signs = [1.0 if max(column, key=abs) >= 0 else -1.0 for column in loadings.T]
    return model.transform(rows).select(*df.columns, *[(parts[i] * signs[i]).alias(f"pc{i + 1}") for i in range(k)])


# Cells within reach of a cell whose diagonal is eps: two steps each way, without the corners.
REACH = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if abs(i) + abs(j) < 4]
SPLIT = 4


def _cell(column: str, size: float) -> Column:
    return F.floor(F.col(column) / F.lit(size)).cast("bigint")


def _ask_neighbours(points: DataFrame) -> DataFrame:
    """For each cell, the given points within reach of it. Points of thin cells only, so lists are short."""
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in REACH]))
    return (
        points.select("id", "x", "y", "cx", "cy", steps.alias("s"))
        .groupBy((F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"))
        .agg(F.collect_list(F.struct("id", "x", "y")).alias("asking"))
    )


def _answers(points: DataFrame, asking: DataFrame, eps: float) -> DataFrame:
    """Pairs (asking point, point within eps), at most a few hundred per point and never within thick cells."""

    def close(q: Column) -> Column:
        dx, dy = q["x"] - F.col("x"), q["y"] - F.col("y")
        return dx * dx + dy * dy <= F.lit(eps * eps)

    met = points.join(asking, ["cx", "cy"]).withColumn("q", F.explode(F.filter("asking", close)))
    return met.drop("asking")


def _gridded(df: DataFrame, eps: float, x: str, y: str, id: str) -> DataFrame:
    side = eps / math.sqrt(2.0)
    points = df.select(F.col(id).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    cell = {k: F.when(_placed(), _cell(c, side)) for k, c in (("cx", "x"), ("cy", "y"))}
    return points.select("*", *[c.alias(k) for k, c in cell.items()])


def _placed() -> Column:
    """Whether a point has a place: both coordinates known and finite."""

    def known(c: str) -> Column:
        return F.coalesce(F.abs(F.col(c)) < float("inf"), F.lit(False))  # NaN is larger than all others

    return known("x") & known("y")


def _with_core(df: DataFrame, eps: float, min_points: int, x: str, y: str, id: str) -> DataFrame:
    """Points with their cell and whether at least `min_points` points, itself included, lie within eps.

    All points of one cell are within eps of each other, so a cell with enough points
    needs no distances at all. Only the few points of thin cells look at their surroundings.
    """
    points = _gridded(df, eps, x, y, id).filter(_placed())
    sizes = settle(points.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n")))
    thin = points.join(sizes.filter(F.col("n") < min_points), ["cx", "cy"])
    asking = settle(_ask_neighbours(thin))
    counts = _answers(points, asking, eps).groupBy(F.col("q.id").alias("id")).agg(F.count(F.lit(1)).alias("near"))
    core = (F.col("n") >= min_points) | (F.coalesce("near", F.lit(0)) >= min_points)
    return (
        points.join(sizes, ["cx", "cy"])
        .join(settle(counts), "id", "left")
        .select("id", "x", "y", "cx", "cy", core.alias("core"))
    )


def density_core(
    df: DataFrame, eps: float = 0.8, min_points: int = 20, x: str = "x", y: str = "y", id: str = "id"
) -> DataFrame:
    """Flag the points that have `min_points` points within eps; points without a place are none of them."""
    flags = _with_core(df, eps, min_points, x, y, id).select("id", F.col("core").cast("int").alias("core"))
    return flags.unionByName(_gridded(df, eps, x, y, id).filter(~_placed()).select("id", F.lit(0).alias("core")))


def _boxes(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    return points.groupBy(*keys).agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
    )


def _as(side: str, boxes: DataFrame) -> DataFrame:
    return boxes.select(*[F.col(c).alias(f"{side}_{c}") for c in boxes.columns])


def _linked_cells(core: DataFrame, eps: float) -> DataFrame:
    """Pairs of neighbouring cells that hold core points within eps of each other.

    Compares bounding boxes instead of points: boxes that are surely close link their
    cells, boxes that are surely apart are dropped, the rest are split further until
    every pair is decided. A box of equal points decides exactly, so this ends.
    """
    side = eps / math.sqrt(2.0)
    cell = ["cx", "cy"]
    boxes = settle(_boxes(core, cell)).select("*", F.col("cx").alias("bx"), F.col("cy").alias("by"))
    ahead = [s for s in REACH if s > (0, 0)]
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ahead]))
    reach = _as("a", boxes).withColumn("s", steps)
    reach = reach.select("*", (F.col("a_cx") + F.col("s.i")).alias("b_cx"), (F.col("a_cy") + F.col("s.j")).alias("b_cy"))
    pairs = reach.drop("s").join(_as("b", boxes), ["b_cx", "b_cy"])

    def gap(k: str) -> Column:
        return F.greatest(F.col(f"a_{k}0") - F.col(f"b_{k}1"), F.col(f"b_{k}0") - F.col(f"a_{k}1"), F.lit(0.0))

    def stretch(k: str) -> Column:
        return F.greatest(F.col(f"a_{k}1") - F.col(f"b_{k}0"), F.col(f"b_{k}1") - F.col(f"a_{k}0"))

    def square(measure: Callable[[str], Column], k: str) -> Column:
        return measure(k) * measure(k)

    ends = ["a_cx", "a_cy", "b_cx", "b_cy"]
    limit = F.lit(eps * eps)
    links: list[DataFrame] = []
    level = 0
    while True:
        judged = settle(
            pairs.select(
                *ends, "a_bx", "a_by", "b_bx", "b_by",
                (square(stretch, "x") + square(stretch, "y") <= limit).alias("close"),
                (square(gap, "x") + square(gap, "y") > limit).alias("apart"),
            )
        )
        links.append(judged.filter("close").select(*ends))
        undecided = judged.filter("not close and not apart").join(links[-1], ends, "left_anti").drop("close", "apart")
        open_ = settle(undecided)
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, links).distinct()
        before, level = side / SPLIT**level, level + 1
        fine = side / SPLIT**level
        parent = core.select(
            *cell, "x", "y", _cell("x", before).alias("px"), _cell("y", before).alias("py"),
            _cell("x", fine).alias("bx"), _cell("y", fine).alias("by"),
        )
        ends_of = [
            open_.select(*[F.col(f"{k}_{c}").alias(c) for c in cell], F.col(f"{k}_bx").alias("px"), F.col(f"{k}_by").alias("py"))
            for k in ("a", "b")
        ]
        needed = ends_of[0].unionByName(ends_of[1])
        parts = settle(_boxes(parent.join(needed, [*cell, "px", "py"], "left_semi"), [*cell, "px", "py", "bx", "by"]))
        todo = open_.select(
            *ends, F.col("a_bx").alias("a_px"), F.col("a_by").alias("a_py"),
            F.col("b_bx").alias("b_px"), F.col("b_by").alias("b_py"),
        )
        pairs = todo.join(_as("a", parts), ["a_cx", "a_cy", "a_px", "a_py"]).join(
            _as("b", parts), ["b_cx", "b_cy", "b_px", "b_py"]
        )


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Smallest node reachable from each node: columns node, label. Edges have columns a, b.

    Each round hands a node, and the label it currently has, the smallest label seen
    across an edge, then lets every node take over its label's label.
    """
    edges = settle(edges.select("a", "b"))
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = nodes.select("node", F.col("node").alias("label"))
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("other")), "b")
        mine = labels.select(F.col("node").alias("a"), F.col("label").alias("own"))
        pairs = seen.join(mine, "a")
        offers = pairs.select(F.col("a").alias("node"), "other").unionByName(
            pairs.select(F.col("own").alias("node"), "other")
        )
        best = offers.groupBy("node").agg(F.min("other").alias("other"))
        hooked = labels.join(best, "node", "left").select(
            "node", F.least("label", F.coalesce("other", "label")).alias("label"), F.col("label").alias("old")
        )
        parents = hooked.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = hooked.join(parents, "label").select("node", F.col("up").alias("label"), "old")
        settled = settle(jumped)
        labels = settled.select("node", "label")
        if settled.filter(F.col("label") != F.col("old")).isEmpty():
            return labels


def density_clusters(
    df: DataFrame, eps: float = 0.8, min_points: int = 20, x: str = "x", y: str = "y", id: str = "id"
) -> DataFrame:
    """Density clusters: id, x, y, core, cluster. 0 is noise; clusters are numbered by their smallest id.

    Core points of one cell share a cluster, so only cells are linked. A border point
    joins the lowest-numbered cluster that has a core point within eps. A point without
    a place (a coordinate null or not finite) is noise.
    """
    points = settle(_with_core(df, eps, min_points, x, y, id))
    core = points.filter("core")
    spot = F.struct("cx", "cy")
    links = _linked_cells(core, eps).select(
        F.struct(F.col("a_cx").alias("cx"), F.col("a_cy").alias("cy")).alias("a"),
        F.struct(F.col("b_cx").alias("cx"), F.col("b_cy").alias("cy")).alias("b"),
    )
    firsts = settle(core.groupBy(spot.alias("node")).agg(F.min("id").alias("first")))
    found = components(links, firsts).join(firsts, "node")
    leaders = found.groupBy("label").agg(F.min("first").alias("first"))
    numbered = running(leaders, [F.col("first")], rank="cluster").select("label", F.col("cluster").cast("int"))
    cells = settle(
        found.join(numbered, "label").select(F.col("node.cx").alias("cx"), F.col("node.cy").alias("cy"), "cluster")
    )
    asking = settle(_ask_neighbours(points.filter("not core")))
    joined = _answers(core.join(cells, ["cx", "cy"]).select("cx", "cy", "x", "y", "cluster"), asking, eps)
    border = settle(joined.groupBy(F.col("q.id").alias("id")).agg(F.min("cluster").alias("near")))
    inner = core.join(cells, ["cx", "cy"]).select("id", "x", "y", F.lit(1).alias("core"), "cluster")
    outer = points.filter("not core").join(border, "id", "left")
    nowhere = _gridded(df, eps, x, y, id).filter(~_placed())
    return inner.unionByName(
        outer.select("id", "x", "y", F.lit(0).alias("core"), F.coalesce("near", F.lit(0)).alias("cluster"))
    ).unionByName(nowhere.select("id", "x", "y", F.lit(0).alias("core"), F.lit(0).alias("cluster")))


def contingency(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Count table of two columns, absent combinations 0."""
    return df.groupBy(rows).pivot(columns, list(values)).count().na.fill(0)


def axis_histogram(df: DataFrame, value: str, group: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per group and equal-width bin; values outside the range go to bins 0 and bins + 1."""
    bucket = F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins))
    return df.groupBy(group, bucket.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
