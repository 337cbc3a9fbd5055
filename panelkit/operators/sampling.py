"""Class sampling and random control columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.columns import LEAVES_IN_1, LEAVES_IN_2, hash_bits, hash_normal, hash_uniform, ordered
from panelkit.functions.durable import settle
from panelkit.functions.running import at_ranks

SLICES = 65536


def undersample_exact(
    df: DataFrame, share: float, seed: object, keys: Sequence[str] = ("id", "ym"), target: str = "target"
) -> DataFrame:
    """All positives and exactly int(negatives * share) negatives; rows without target are dropped.

    Negatives are taken in the order of a hash of their key. Instead of sorting them all,
    a count per slice of the hash range finds the slice holding the last one to keep, and counts per bucket of that
    slice the bucket to be ordered. The sample itself is then one filter over the input.
    """
    bits = hash_bits(seed, *keys)
    negatives = df.filter(F.col(target) == 0).select(*keys, bits.alias("_bits"))
    slice_ = F.expr(f"_bits div {4294967296 // SLICES}")
    counts = settle(negatives.groupBy(slice_.alias("_slice")).agg(F.count(F.lit(1)).alias("_n")))
    upto = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    wanted = counts.agg(F.floor(F.sum("_n") * F.lit(float(share)))).scalar()
    # at most SLICES rows; the slice in which the running count reaches the wanted number
    edge = (
        counts.select("_slice", "_n", F.sum("_n").over(upto).alias("_upto"))
        .filter(F.col("_upto") >= wanted)
        .orderBy("_slice")
        .limit(1)
        .select("_slice", (wanted - (F.col("_upto") - F.col("_n"))).alias("_take"))
    ).first()
    if edge is None:
        return df.filter(F.col(target) == 1)
    in_edge = negatives.filter(slice_ == edge["_slice"])
    last = at_ranks(in_edge, [F.col("_bits"), *[F.col(k) for k in keys]], [edge["_take"]]).first()
    if last is None:
        return df.filter((F.col(target) == 1) | ((F.col(target) == 0) & (slice_of(bits) < edge["_slice"])))
    here = F.struct(bits.alias("_bits"), *keys)
    limit = F.struct(F.lit(last["_bits"]).cast("bigint").alias("_bits"), *[F.lit(last[k]).cast(df.schema[k].dataType).alias(k) for k in keys])
    return df.filter((F.col(target) == 1) | ((F.col(target) == 0) & (here <= limit)))


def slice_of(bits: Column) -> Column:
    return F.floor(bits / F.lit(4294967296 // SLICES))


def undersample_bernoulli(
    df: DataFrame,
    share: float,
    seed: object,
    keys: Sequence[str] = ("id", "ym"),
    label: str = "label",
    always: Sequence[str] = (LEAVES_IN_1, LEAVES_IN_2),
) -> DataFrame:
    """Each row with probability `share`, and every leaver; undetermined rows can be drawn."""
    drawn = hash_uniform(seed, *keys) <= F.lit(float(share))
    return df.filter(drawn | F.coalesce(F.col(label).isin(*always), F.lit(False)))


def shuffled(df: DataFrame, seed: object, keys: Sequence[str] = ("id", "ym")) -> DataFrame:
    """Rows in a reproducible random order (a distributed range sort)."""
    return df.orderBy(hash_bits(seed, *keys), *keys)


def canary_count(features: int, ratio: float) -> int:
    return max(1, int(features * ratio))


def add_canaries(
    df: DataFrame,
    n: int | None = None,
    ratio: float = 0.5,
    seed: int = 4177,
    keys: Sequence[str] = ("id", "ym"),
    ignore: Sequence[str] = ("id", "ym", "label"),
    kind: str = "normal",
    reproducible: bool = True,
) -> DataFrame:
    """Add random control columns in front of all others.

    Without `n`, their number is a share of the feature columns. reproducible=True draws
    them from a hash of the row's key, otherwise from the engine's generators.
    """
    if n is None:
        n = canary_count(len([c for c in df.columns if c not in set(ignore)]), ratio)
    first = 0 if kind == "normal" else 1
    name = "canarito_{:03d}" if kind == "normal" else "canarito_{}"

    def draw(i: int) -> Column:
        if kind == "normal":
            return hash_normal(f"{seed}-{i}", *keys) if reproducible else F.randn(seed + i)
        return hash_uniform(f"{seed}-{i}", *keys) if reproducible else F.rand(seed + i)

    canaries = {name.format(i): draw(i) for i in range(first, first + n)}
    return ordered(df.select("*", *[e.alias(c) for c, e in canaries.items()]), list(canaries))


def class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Weight each row by one over the number of rows in its class."""
    weights = settle(df.filter(F.col(label).isNotNull()).groupBy(label).agg((F.lit(1.0) / F.count(F.lit(1))).alias(name)))
    return df.join(weights, label, "left").select(*df.columns, name)
