"""Exact grouped quantiles whose groups may be far larger than one task can hold.

A mergeable sketch per group brackets every wanted quantile between two values that are about two percent of the rows
apart. The ends of all brackets of a group cut its values into elementary intervals: one sorted array per group and
column, in which a second scan looks up every value once. Rows per interval are counted, and distinct values tallied in
intervals that a bracket covers. All further work is on these small tables: counts are added up over earlier periods,
the interval that holds a wanted rank is found, and only its tallies are ranked. A rank in an interval without tallies
(its bracket missed) makes that interval the bracket of another scan, so the result is exact.

The brackets of a group of few rows are wider (see WIDTHS), which saves another scan; the result doesn't depend on it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.durable import settle
from panelkit.functions.running import running

SKETCH_SIZE = 2048
MARGIN = 0.01
#: margins in place of a smaller one that is less than two rows of the group
WIDTHS = (0.05, 0.25, 1.0)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    group: Sequence[str] = (),
    method: str = "cont",
    before: str | None = None,
    margin: float = MARGIN,
) -> DataFrame:
    """Quantiles in long form: group columns, `column`, `prob`, `value`.

    method: "cont" interpolates between neighbours, "disc" takes the nearest rank.
    before: with a period column, the row for period m covers all rows of strictly earlier periods.
    Groups (and periods) with null keys are left out; null values and values that are no numbers (NaN) are ignored.
    """
    group = list(group)
    cells = [*group, before] if before else group
    data = df.dropna(subset=cells) if cells else df
    whole = [*group, "column"]

    sketches = _sketches(data, columns, cells)
    if before:
        sketches = _merge_earlier(settle(sketches), group, before)
    wanted = settle(_brackets(sketches, [*cells, "column"], probs, method, margin))
    open_, found = wanted, []
    while True:
        cuts = settle(_cuts(open_, whole))
        tallies = settle(_tally(data, columns, cuts, cells, whole))
        ranked = settle(_intervals(open_, cuts, tallies, cells, whole, before))
        found.append(_picked(ranked.filter("tallied"), tallies, cells, whole, before))
        lost = ranked.filter("not tallied")
        if not lost.head(1):
            break
        # the interval that holds the rank is the bracket of the next scan
        open_ = settle(lost.select(*cells, "column", "prob", "side", "rank", "low", "high"))
    values = settle(reduce(DataFrame.unionByName, found))
    keys = [*cells, "column", "prob"]
    sides = values.groupBy(*keys).agg(*[F.max(F.when(F.col("side") == s, F.col("value"))).alias(f"_{s}") for s in ("first", "last")])
    # a group of one quantile per key: the share between its two neighbours
    shares = wanted.filter("side = 'first'").select(*keys, "share")
    return sides.join(shares, keys).select(*keys, (F.col("_first") + (F.col("_last") - F.col("_first")) * F.col("share")).alias("value"))


def _value(column: str) -> Column:
    number = F.col(column).cast("double")
    return F.when(~F.isnan(number), number)


def _sketches(data: DataFrame, columns: Sequence[str], cells: list[str]) -> DataFrame:
    wide = data.groupBy(*cells).agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(_value(c)).alias("n"),
                F.kll_sketch_agg_double(_value(c), SKETCH_SIZE).alias("sketch"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    entries = F.explode(F.array(*[F.col(f"_{i}") for i in range(len(columns))])).alias("e")
    return wide.select(*cells, entries).select(*cells, "e.column", "e.n", "e.sketch")


def _merge_earlier(sketches: DataFrame, group: list[str], before: str) -> DataFrame:
    """Sketch of everything strictly before each period; works on the small sketch table only."""
    targets = sketches.select(F.col(before).alias("_target")).distinct()
    earlier = sketches.join(targets, F.col(before) < F.col("_target"))
    return earlier.groupBy(*group, F.col("_target").alias(before), "column").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch")
    )


def _brackets(sketches: DataFrame, scope: list[str], probs: Sequence[float], method: str, margin: float) -> DataFrame:
    """Per quantile and side (the two ranks it lies between): rank, share, and the bracket from low to high; a null end
    is open."""
    position = F.col("prob") * (F.col("n") - 1)
    if method == "cont":
        first, last, share = F.floor(position) + 1, F.ceil(position) + 1, position - F.floor(position)
    elif method == "disc":
        # the nearest rank; the rounding keeps 0.95 * 20 at 19 despite binary fractions
        first = F.greatest(F.ceil(F.round(F.col("prob") * F.col("n"), 9)), F.lit(1))
        last, share = first, F.lit(0.0)
    else:
        raise ValueError(f"unknown method {method!r}")

    def end(at: float) -> Column:
        return F.kll_sketch_get_quantile_double("sketch", F.lit(at)) if 0 < at < 1 else F.lit(None).cast("double")

    def bracket(p: float) -> Column:
        widths = [margin, *[w for w in WIDTHS if w > margin]]

        def chosen(sign: int) -> Column:
            out = end(p + sign * widths[-1])
            for w in reversed(widths[:-1]):
                out = F.when(F.col("n") * w > 2, end(p + sign * w)).otherwise(out)
            return out

        return F.struct(F.lit(float(p)).alias("prob"), chosen(-1).alias("low"), chosen(1).alias("high"))

    ranked = (
        sketches.filter("n > 0")
        .select(*scope, "n", F.explode(F.array(*[bracket(p) for p in probs])).alias("b"))
        .select(*scope, "n", "b.prob", "b.low", "b.high")
        .select("*", share.alias("share"), first.cast("bigint").alias("first"), last.cast("bigint").alias("last"))
    )
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("rank")) for s in ("first", "last")])).alias("e")
    return ranked.select(*scope, "prob", "share", "low", "high", sides).select(*scope, "prob", "share", "low", "high", "e.side", "e.rank")


def _cuts(wanted: DataFrame, whole: list[str]) -> DataFrame:
    """Per group and column the ends of all brackets, sorted, and for each elementary interval whether a bracket covers it.

    With cuts c[0] to c[m - 1], interval 2k + 1 is the value c[k] itself, 2k lies below c[k] and above c[k - 1].
    """
    ends = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_compact(F.array("low", "high"))))))
    cut = wanted.groupBy(*whole).agg(ends.alias("cuts"), F.collect_set(F.struct("low", "high")).alias("_brackets"))

    def covered(i: Column) -> Column:
        # the interval's own ends, null where it is open
        below, above = F.get("cuts", (F.floor((i + 1) / 2) - 1).cast("int")), F.get("cuts", F.floor(i / 2).cast("int"))
        return F.exists("_brackets", lambda b: (b["low"].isNull() | (below >= b["low"])) & (b["high"].isNull() | (above <= b["high"])))

    numbers = F.sequence(F.lit(0), 2 * F.size("cuts"))
    return cut.select(*whole, "cuts", F.transform(numbers, lambda i: F.coalesce(covered(i), F.lit(False))).alias("covered"))


def _interval(v: Column, cuts: Column) -> Column:
    """Number of the elementary interval that holds v, by halving."""
    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        going, above = state["low"] < state["high"], F.get(cuts, middle) < v
        return F.struct(F.when(going & above, middle + 1).otherwise(state["low"]).alias("low"),
                        F.when(going & ~above, middle).otherwise(state["high"]).alias("high"))

    turns = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + F.lit(1))).cast("int"))
    at = F.aggregate(turns, F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high")), halve)["low"]
    return F.aggregate(F.array(at), F.lit(0), lambda _, k: 2 * k + F.coalesce((F.get(cuts, k) == v).cast("int"), F.lit(0)))


def _tally(data: DataFrame, columns: Sequence[str], cuts: DataFrame, cells: list[str], whole: list[str]) -> DataFrame:
    """Rows per cell, column and elementary interval, by distinct value where a bracket covers the interval."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _value(c).alias("v")) for c in columns]))
    values = data.select(*cells, pairs.alias("e")).select(*cells, "e.column", "e.v").filter("v is not null")
    placed = values.join(cuts, whole).withColumn("interval", _interval(F.col("v"), F.col("cuts")))
    tallied = F.get("covered", F.col("interval"))
    return placed.groupBy(*cells, "column", "interval", F.when(tallied, F.col("v")).alias("v")).agg(F.count("*").alias("rows"))


def _intervals(
    wanted: DataFrame, cuts: DataFrame, tallies: DataFrame, cells: list[str], whole: list[str], before: str | None
) -> DataFrame:
    """The wanted ranks with the interval that holds them, the rank within it, its ends and whether it is tallied."""
    counts = tallies.groupBy(*cells, "column", "interval").agg(F.sum("rows").alias("rows"))
    if before:
        # every interval at every period asked for: rows of earlier periods
        periods = wanted.select(*whole, before).distinct().withColumn("rows", F.lit(0).cast("long"))
        asked = counts.select(*whole, "interval").distinct().join(periods, whole)
        both = counts.withColumn("_asked", F.lit(0)).unionByName(asked.withColumn("_asked", F.lit(1)))
        # what is asked at a period stands in front of the period's own rows
        earlier = Window.partitionBy(*whole, "interval").orderBy(before, F.desc("_asked")).rowsBetween(Window.unboundedPreceding, -1)
        counts = both.withColumn("rows", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).filter("_asked = 1").drop("_asked")
    upto = Window.partitionBy(*cells, "column").orderBy("interval").rowsBetween(Window.unboundedPreceding, 0)
    summed = settle(counts.withColumn("_upto", F.sum("rows").over(upto)).withColumn("_below", F.col("_upto") - F.col("rows")))
    scope = [*cells, "column"]
    asked = wanted.select(*scope, "prob", "side", "rank")
    end = lambda i: F.get("cuts", F.floor(i).cast("int"))
    i = F.col("interval")
    return (
        asked.join(summed, scope).filter("rank > _below and rank <= _upto").join(cuts, whole)
        .select(*scope, "prob", "side", "rank", "interval", (F.col("rank") - F.col("_below")).alias("_rank"),
                F.get("covered", i).alias("tallied"), end((i + 1) / 2 - 1).alias("low"), end(i / 2).alias("high"))
    )


def _picked(
    ranked: DataFrame, tallies: DataFrame, cells: list[str], whole: list[str], before: str | None
) -> DataFrame:
    """The values at the wanted ranks, from the tallies of their intervals, without sorting one in a single task."""
    keys = [*cells, "column", "prob", "side"]
    inside = tallies.filter("v is not null").select(*[F.col(c).alias("_period") if c == before else c for c in cells], "column", "interval", "v", "rows")
    met = ranked.select(*keys, "interval", "_rank").join(inside, [*whole, "interval"])
    if before:
        met = met.filter(F.col("_period") < F.col(before))
    summed = running(met.groupBy(*keys, "_rank", "v").agg(F.sum("rows").alias("rows")), [F.col("v")], keys, {"upto": F.col("rows")})
    return summed.filter("upto >= _rank").groupBy(*keys).agg(F.min("v").alias("value"))


def spread(quantiles: DataFrame, group: Sequence[str], names: dict[tuple[str, float], str]) -> DataFrame:
    """Long quantiles to one row per group, with a column for each (column, prob) named."""
    return quantiles.groupBy(*group).agg(
        *[
            F.max(F.when((F.col("column") == c) & (F.col("prob") == F.lit(float(p))), F.col("value"))).alias(n)
            for (c, p), n in names.items()
        ]
    )


def prob_tag(prob: float) -> str:
    """q10 for 0.1, q2_5 for 0.025."""
    return "q" + re.sub(r"\.", "_", f"{round(prob * 100, 6):g}")
