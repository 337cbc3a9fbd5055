"""Rescaling of monetary columns by statistics of their period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.columns import LEAVES_IN_1, LEAVES_IN_2, STAYS, replace_columns, total
from panelkit.functions.durable import settle
from panelkit.functions.quantiles import exact_quantiles, prob_tag, spread


def _join_periods(df: DataFrame, stats: DataFrame, period: str) -> DataFrame:
    """Attach per-period statistics. The settled table has a known size: small ones are broadcast."""
    return df.join(stats, period, "left")


def limit_means(df: DataFrame, limits: tuple[str, str], period: str = "ym") -> DataFrame:
    """Mean of two limits per period, and of their average where both are known."""
    a, b = limits
    return df.groupBy(period).agg(
        F.avg(a).alias("mean_a"), F.avg(b).alias("mean_b"), F.avg((F.col(a) + F.col(b)) / 2).alias("mean_both")
    )


def scale_by_limit(
    df: DataFrame, columns: Sequence[str], limits: tuple[str, str], period: str = "ym", unit: float = 10000.0
) -> DataFrame:
    """Express amounts in `unit`ths of the period's mean limit; the limits themselves stay."""
    stats = settle(limit_means(df, limits, period).select(period, F.col("mean_both").alias("_limit")))
    scaled = {
        c: F.try_divide(F.col(c).cast("double") * unit, F.col("_limit")) for c in columns if c not in limits
    }
    return replace_columns(_join_periods(df, stats, period), scaled).select(*df.columns)


def deflate(
    df: DataFrame, columns: Sequence[str], index: DataFrame, period: str = "ym", value: str = "index"
) -> DataFrame:
    """Divide by a price index per period; a period without index gives null."""
    prices = settle(index.select(period, F.col(value).cast("double").alias("_index")))
    scaled = {c: F.try_divide(F.col(c).cast("double"), F.col("_index")) for c in columns}
    return replace_columns(_join_periods(df, prices, period), scaled).select(*df.columns)


def scale_by_p95(
    df: DataFrame, columns: Sequence[str], period: str = "ym", method: str = "disc", prob: float = 0.95
) -> DataFrame:
    """Divide by the period's 95th percentile of |c|.

    method: "disc" nearest rank, "cont" interpolated, "approx" the built-in sketch.
    """
    if not columns:
        raise ValueError("no columns to scale")
    sizes = df.select(period, *[F.abs(F.col(c)).alias(c) for c in columns])
    marks = {c: f"_mark_{c}" for c in columns}
    if method == "approx":
        stats = sizes.groupBy(period).agg(*[F.percentile_approx(c, prob).cast("double").alias(m) for c, m in marks.items()])
    else:
        stats = spread(
            exact_quantiles(sizes, columns, [prob], [period], method),
            [period],
            {(c, prob): m for c, m in marks.items()},
        )
    joined = _join_periods(df, settle(stats), period)
    scaled = {c: F.try_divide(F.col(c).cast("double"), F.col(m)) for c, m in marks.items()}
    return replace_columns(joined, scaled).select(*df.columns)


def period_moments(df: DataFrame, columns: Sequence[str], period: str = "ym") -> DataFrame:
    """Mean and sample deviation of each column per period."""
    return df.groupBy(period).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_samp(c).alias(f"{c}_std") for c in columns]
    )


# The weights of the two published projection terms.
PROJECTION_WEIGHTS = {
    "ctrx_quarter": (-0.5451, -0.6825),
    "mcuentas_saldo": (-0.0264, -0.8541),
    "mpasivos_margen": (-0.1729, -0.0899),
    "cdescubierto_preacordado_delta_lag_1": (-0.6106, -0.1276),
    "mrentabilidad_annual_lag_2": (0.0951, 0.3177),
    "Visa_status": (0.2962, -0.5178),
    "cpayroll_trx": (-0.4514, -0.3249),
    "mrentabilidad_annual_lag_1": (-0.1498, -0.8664),
    "Visa_fechaalta_lag_2": (0.1278, -0.0956),
    "Master_mfinanciacion_limite": (0.0197, -0.0956),
}


def projection_terms(
    df: DataFrame,
    weights: dict[str, tuple[float, ...]] = PROJECTION_WEIGHTS,
    period: str = "ym",
    name: str = "ppr_term_{k}",
) -> DataFrame:
    """Weighted sums of the columns' z-scores within their period; any null makes the term null."""
    joined = _join_periods(df, settle(period_moments(df, list(weights), period)), period)
    z = {c: F.try_divide(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_std")) for c in weights}
    terms = len(next(iter(weights.values())))
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[total(z[c] * w[k] for c, w in weights.items()).alias(name.format(k=k + 1)) for k in range(terms)],
    )


def class_distance(
    df: DataFrame,
    columns: Sequence[str],
    train_periods: Sequence[int],
    probs: Sequence[float] = (0.1, 0.5, 0.9),
    label: str = "label",
    period: str = "ym",
    classes: Sequence[str] = (STAYS, LEAVES_IN_1, LEAVES_IN_2),
) -> DataFrame:
    """Distance of each value to each class's quantiles in the training periods."""
    known = df.filter(F.col(period).isin(*train_periods) & F.col(label).isin(*classes))
    quantiles = exact_quantiles(known, columns, probs, [label])
    names = _distance_names(columns, probs, classes)
    # a single row: one value per class, probability and column
    marks = quantiles.agg(F.struct(*[_mark(k, label).alias(n) for k, n in names.items()])).scalar()
    return df.select(
        "*", *[(F.col(c).cast("double") - marks[n]).alias(n) for (_, _, c), n in names.items()]
    )


def class_distance_rolling(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = (0.2, 0.5, 0.8),
    label: str = "label",
    period: str = "ym",
    classes: Sequence[str] = (STAYS, LEAVES_IN_1, LEAVES_IN_2),
) -> DataFrame:
    """Distance of each value to each class's quantiles over strictly earlier periods.

    Null in the first period and wherever a class has not been seen yet.
    """
    # keep undetermined rows under another name, so that their periods still get a target row
    seen = df.select(period, F.coalesce(F.col(label), F.lit("")).alias(label), *columns)
    quantiles = exact_quantiles(seen, columns, probs, [label], before=period)
    names = _distance_names(columns, probs, classes)
    marks = settle(quantiles.groupBy(period).agg(*[_mark(k, label).alias(f"_{n}") for k, n in names.items()]))
    joined = _join_periods(df, marks, period)
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(c).cast("double") - F.col(f"_{n}")).alias(n) for (_, _, c), n in names.items()],
    )


def _distance_names(
    columns: Sequence[str], probs: Sequence[float], classes: Sequence[str]
) -> dict[tuple[str, float, str], str]:
    return {(k, p, c): f"dist_{k}_{prob_tag(p)}_{c}" for k in classes for c in columns for p in probs}


def _mark(key: tuple[str, float, str], label: str) -> Column:
    cls, prob, column = key
    hit = (F.col(label) == cls) & (F.col("prob") == F.lit(float(prob))) & (F.col("column") == column)
    return F.max(F.when(hit, F.col("value")))
