"""Ranks and running sums over a global order, without sorting in one task.

Rows are dealt to buckets whose bounds are a pure function of the order's values: a box between the least and the
largest value is cut into equal steps, rows and sums per bucket are counted, and a bucket that holds too many rows is a
box of its own in the next round. Values that tie are told apart by the next column of the order, so that even a score
shared by most rows is cut. The totals of the buckets before it, a small table, give each bucket its offset; rows then
move once, to their bucket, and are summed there.

A rank wanted by number needs no more than its own bucket: see at_ranks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.durable import settle

#: steps of a box, and rows that a bucket may hold while its rows still differ
STEPS = 1024
BUCKET_ROWS = 1 << 18
#: rounds after which a bucket stays as it is, however large
ROUNDS = 60
LARGEST = 1.7976931348623157e308


@dataclass(frozen=True)
class Down:
    """A column of an order, largest values first, nulls last."""

    column: Column


def down(column: Column | str) -> Down:
    return Down(F.col(column) if isinstance(column, str) else column)


Order = Sequence[Column | Down]


def _digit(name: str, kind: T.DataType, falling: bool) -> Column:
    """A number that never falls along the order of the column; it may stay the same where the column goes on."""
    value = F.col(name)
    if isinstance(kind, T.StringType):
        number = F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    elif isinstance(kind, T.NumericType):
        # what is no number is largest in Spark's order
        number = F.greatest(F.least(F.nanvl(value.cast("double"), F.lit(LARGEST)), F.lit(LARGEST)), F.lit(-LARGEST))
    elif isinstance(kind, T.DateType):
        number = F.unix_date(value).cast("double")
    elif isinstance(kind, T.TimestampType):
        number = F.unix_micros(value).cast("double")
    else:
        number = F.lit(0.0)
    number = F.when(value.isNull(), F.lit(-LARGEST)).otherwise(number)
    return -number if falling else number


def _step(x: Column, low: Column, high: Column, steps: int) -> Column:
    """The step between low and high in which x lies, from 0; never falls as x grows. Far ends are halved, so that their
    distance is a number."""
    far = F.greatest(F.abs(low), F.abs(high)) > LARGEST / 4
    share = F.when(far, (x / 2 - low / 2) / (high / 2 - low / 2)).otherwise((x - low) / (high - low))
    return F.least(F.lit(steps - 1), F.floor(share * steps).cast("int"))


class Buckets:
    """Rows dealt to buckets, and what lies before each bucket in its group."""

    def __init__(self, df: DataFrame, order: Order, group: Sequence[str], sums: dict[str, Column], bucket_rows: int, steps: int):
        self.columns, self.group, self.sums = df.columns, list(group), list(sums)
        self.order = [F.col(f"_o{i}").desc() if isinstance(o, Down) else F.col(f"_o{i}") for i, o in enumerate(order)]
        keys = {f"_g{i}": F.col(f"`{g}`") for i, g in enumerate(self.group)} or {"_g0": F.lit(1)}
        ordered = {f"_o{i}": o.column if isinstance(o, Down) else o for i, o in enumerate(order)}
        summed = {f"_s{i}": e for i, e in enumerate(sums.values())}
        body = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
        self.rows = settle(df.select(body, *[e.alias(n) for n, e in {**keys, **ordered, **summed}.items()]))
        digits = [_digit(n, self.rows.schema[n].dataType, isinstance(o, Down)) for n, o in zip(ordered, order)]
        self._deal([*keys], digits, [*summed], bucket_rows, steps)

    def _deal(self, keys: list[str], digits: list[Column], summed: list[str], bucket_rows: int, steps: int) -> None:
        def span(i: int, digit: Column) -> Column:
            value = f"_o{i}"
            # equal numbers may stand for several values: only where these are one does the next column decide
            one = F.min(value).eqNullSafe(F.max(value)) & F.count(value).isin(F.lit(0), F.count("*"))
            return F.struct(F.min(digit).alias("low"), F.max(digit).alias("high"), one.alias("one")).alias(f"_d{i}")

        spans = [span(i, d) for i, d in enumerate(digits)]
        totals = [F.count("*").alias("_n"), *[F.sum(s).alias(s) for s in summed], *spans]
        bounds = F.array(*[F.col(f"_d{i}") for i in range(len(digits))])
        key = F.coalesce(*[F.when(~F.col(f"_d{i}.one"), F.lit(i)) for i in range(len(digits))], F.lit(0))
        offsets = ["_before", *[f"_before{s}" for s in summed]]

        def judged(counted: DataFrame, turn: int) -> DataFrame:
            """Buckets with a number; those still to be cut know along which column."""
            large = (F.col("_n") > bucket_rows) & (F.col("_span.low") < F.col("_span.high")) & F.lit(turn < ROUNDS)
            return settle(
                counted.withColumns({"_bucket": F.monotonically_increasing_id() * (ROUNDS + 1) + turn, "_span": F.element_at(bounds, key + 1)})
                .withColumn("_key", F.when(large, key)).drop(*[f"_d{i}" for i in range(len(digits))])
            )

        # null is a group like any other
        same = reduce(lambda a, k: a & F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")), keys, F.lit(True))
        first = self.rows.groupBy(*keys).agg(*totals)
        kinds = {"_before": T.LongType(), **{f"_before{s}": first.schema[s].dataType for s in summed}}
        buckets = judged(first.withColumns({o: F.lit(0).cast(kinds[o]) for o in offsets}), 0)
        fixed = ["_bucket", *offsets]
        live = self.rows.alias("r").join(buckets.alias("b"), same).select(
            *[F.col(f"r.{c}") for c in self.rows.columns], *[F.col(f"b.{c}") for c in (*fixed, "_key", "_span")])
        self.parts, self.tables, turn = [], [], 0
        while True:
            self.parts.append(live.filter("_key is null").drop("_key", "_span"))
            self.tables.append(buckets.filter("_key is null").select(*keys, "_n", *summed, *fixed))
            if not buckets.filter("_key is not null").head(1):
                return
            turn += 1
            x = F.element_at(F.array(*digits), F.col("_key") + 1)
            cut = live.filter("_key is not null").withColumn("_step", _step(x, F.col("_span.low"), F.col("_span.high"), steps))
            cut = settle(cut.drop("_key", "_span").withColumnsRenamed({c: f"{c}_" for c in fixed}))
            over = Window.partitionBy("_bucket_").orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
            earlier = {"_before": F.sum("_n"), **{f"_before{s}": F.sum(s) for s in summed}}
            counted = (
                cut.groupBy(*keys, "_bucket_", "_step", *[f"{o}_" for o in offsets]).agg(*totals)
                .withColumns({o: (F.col(f"{o}_") + F.coalesce(e.over(over), F.lit(0))).cast(kinds[o]) for o, e in earlier.items()})
                .drop(*[f"{o}_" for o in offsets])
            )
            buckets = judged(counted, turn)
            live = cut.drop(*[f"{o}_" for o in offsets]).join(
                buckets.select(*fixed, "_key", "_span", "_bucket_", "_step"), ["_bucket_", "_step"]).drop("_bucket_", "_step")

    @property
    def table(self) -> DataFrame:
        """A row per bucket: rows and sums in it and before it."""
        return reduce(DataFrame.unionByName, self.tables)

    def ranked(self, rank: str, wanted: Sequence[int] | None = None) -> DataFrame:
        """The rows with rank and running sums; with `wanted`, rows of these ranks, out of the buckets that hold them."""
        rows = reduce(DataFrame.unionByName, self.parts)
        if wanted is not None:
            ranks = F.array(*[F.lit(int(w)).cast("long") for w in sorted(set(wanted))]) if wanted else F.array().cast("array<bigint>")
            holding = self.table.filter(F.exists(ranks, lambda w: (w > F.col("_before")) & (w <= F.col("_before") + F.col("_n"))))
            rows = rows.join(settle(holding.select("_bucket")), "_bucket", "left_semi")
        upto = Window.partitionBy("_bucket").orderBy(*self.order).rowsBetween(Window.unboundedPreceding, 0)
        out = rows.select(
            "_row", (F.col("_before") + F.count("*").over(upto)).alias(rank),
            *[(F.col(f"_before_s{i}") + F.coalesce(F.sum(f"_s{i}").over(upto), F.lit(0))).alias(n) for i, n in enumerate(self.sums)],
        )
        if wanted is not None:
            out = out.filter(F.array_contains(ranks, F.col(rank)))
        return out.select("_row.*", rank, *self.sums)


def running(
    df: DataFrame,
    order: Order,
    group: Sequence[str] = (),
    sums: dict[str, Column] | None = None,
    rank: str = "rank",
    bucket_rows: int = BUCKET_ROWS,
    steps: int = STEPS,
) -> DataFrame:
    """Add the 1-based rank and running sums of each row within its group.

    `order` must name a unique key within the group, otherwise ranks of equal rows are arbitrary. Null is a group like
    any other. Ascending columns begin with nulls, those marked `down` end with them.
    """
    return Buckets(df, order, group, sums or {}, bucket_rows, steps).ranked(rank)


def at_ranks(
    df: DataFrame,
    order: Order,
    wanted: Sequence[int],
    group: Sequence[str] = (),
    sums: dict[str, Column] | None = None,
    rank: str = "rank",
    bucket_rows: int = BUCKET_ROWS,
    steps: int = STEPS,
) -> DataFrame:
    """The rows of the wanted ranks, as `running` gives them; only buckets that hold one are moved and sorted."""
    return Buckets(df, order, group, sums or {}, bucket_rows, steps).ranked(rank, wanted)
