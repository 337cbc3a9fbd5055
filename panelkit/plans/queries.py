"""The registered queries: every operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.columns import (
    family, hash_bits, hash_uniform, matching, month_ordinal, numeric, replace_columns, rounded,
)
from panelkit.functions.durable import settle, shared_folder
from panelkit.functions.running import running
from panelkit.operators import (
    clusters, gain, history, labels, models, repair, sampling, scale, search, selection, snapshot, trees,
)
from panelkit.plans.panels import (
    customer_month, customer_points, dead_month, hash_scores, last_day, last_month, supplier_month, table, user_day,
)
from panelkit.plans import study
from panelkit.sources import arrivals
from panelkit.sources import panel as panel_files
from panelkit.sources import reports, trials

Query = Callable[[SparkSession, str], DataFrame]

MONEY = ["mprice", "Visa_mdisc", "Master_mtax", "mqty"]
KEY = ("id", "period")
CUTOFFS = list(range(100, 2001, 100))
FINE_CUTOFFS = list(range(50, 2001, 50))
CLASSES = ["BAJA+1", "BAJA+2", "CONTINUA"]
TRAIN_DAYS = list(range(1, 21))
SEEDS = (11, 23, 37, 51, 67)
#: a search short enough to be repeated often: at most 16 trees, leaves that small tables can fill
SHORT = {"num_iterations_exp": (0.0, 4.0), "min_data_exp": (0.0, 3.0), "num_leaves_exp": (1.0, 4.0)}
TRIALS = 4
FAST = models.TreeParams(iterations=5, rate=0.3, leaves=8, rows_per_leaf=20)
ROLLING = models.TreeParams(iterations=2, rate=0.3, leaves=4, rows_per_leaf=20)
DEEP = models.TreeParams(iterations=5, leaves=128, rows_per_leaf=1)
#: models fitted at the same time
SIDE_BY_SIDE = 5


def _round_all(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return replace_columns(df, {c: rounded(F.col(c), d) for c, d in digits.items()})


def _labelled(spark: SparkSession, sf: str, horizon: int = 2) -> DataFrame:
    return labels.label_attrition(
        user_day(spark, sf), period="period", yyyymm=False, horizon=horizon, last=last_day(spark, sf)
    )


def _with_target(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf).select("*", labels.binary_target().alias("target"))


# panels that a query reads more than once are landed first, as a panel would be


def _suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return settle(supplier_month(spark, sf))


def _broken_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return dead_month(_suppliers(spark, sf))


# labels and targets


def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return labels.class_counts(_labelled(spark, sf), ["period"]).orderBy("period", "label")


def label_counts_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    last = last_month(spark, sf, "lineitem", "l_shipdate")
    return labels.class_counts(labels.label_attrition(supplier_month(spark, sf), last=last), ["ym"])


def label_counts_customers(spark: SparkSession, sf: str) -> DataFrame:
    last = last_month(spark, sf, "orders", "o_orderdate")
    return labels.class_counts(labels.label_attrition(customer_month(spark, sf), last=last), ["ym"])


def label_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return labels.class_counts_wide(_labelled(spark, sf), CLASSES, "period")


def label4_counts(spark: SparkSession, sf: str) -> DataFrame:
    return labels.class_counts(_labelled(spark, sf, 3), [])


def label4_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf, 3).select(*KEY, "label")


def target_modes(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf).select(
        *KEY,
        labels.binary_target().alias("target"),
        labels.binary_target_filled().alias("target_filled"),
        labels.strict_target().alias("strict"),
        labels.training_flag("period", TRAIN_DAYS).alias("training"),
    )


def cluster_class_tenure(spark: SparkSession, sf: str) -> DataFrame:
    rows = labels.with_tenure(_labelled(spark, sf), period="period", yyyymm=False)
    rows = rows.select(*KEY, "tenure", labels.leaver_class().alias("leaver"))
    return labels.established_or_leaving(rows)


def tenure_modes(spark: SparkSession, sf: str) -> DataFrame:
    rows = labels.with_tenure(customer_month(spark, sf))
    rows = labels.with_tenure(rows, mode="reference", name="tenure_reference")
    return rows.select("id", "ym", "tenure", "tenure_reference")


# history


def lag_delta_chained(spark: SparkSession, sf: str) -> DataFrame:
    rows = history.add_history(supplier_month(spark, sf), [*MONEY, "unknown"], lags=(1, 2), chained=2)
    return _round_all(rows, {f"{c}_delta_lag_{i}": 4 for c in MONEY for i in (1, 2)})


def lag_delta_anchored(spark: SparkSession, sf: str) -> DataFrame:
    rows = history.add_history(
        supplier_month(spark, sf), ["cl", "mprice"], lags=(1, 2, 3, 6, 12), anchored=(1, 2), lag_name="{c}_lag{i}"
    )
    return _round_all(rows, {"mprice_delta1": 4, "mprice_delta2": 4})


def lag_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return history.add_history(customer_month(spark, sf), ["corders", "mtotal"], lags=(1, 2), calendar=True)


def trend_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = history.add_history(supplier_month(spark, sf), ["cl", "mprice", "mqty"], slope=True)
    rows = rows.select("id", "ym", "cl_tend6", "mprice_tend6", "mqty_tend6")
    return _round_all(rows, {"cl_tend6": 6, "mprice_tend6": 3, "mqty_tend6": 4})


def trend_window_nulls(spark: SparkSession, sf: str) -> DataFrame:
    rows = history.add_history(user_day(spark, sf), ["mpurchase", "Visa_mclick"], period="period", slope=True)
    rows = rows.select(*KEY, "mpurchase_tend6", "Visa_mclick_tend6")
    return _round_all(rows, {"mpurchase_tend6": 5, "Visa_mclick_tend6": 5})


def window_ratios(spark: SparkSession, sf: str) -> DataFrame:
    rows = history.add_history(supplier_month(spark, sf), ["mprice", "cl"], extremes=True, ratios=True)
    made = [c for c in rows.columns if "6" in c]
    rows = rows.select("id", "ym", *made)
    return _round_all(rows, {c: 4 for c in made if "avg" in c or "ratio" in c})


def feature_block(spark: SparkSession, sf: str) -> DataFrame:
    """Label, lags, both deltas, slope and ratios of the whole panel on one shuffle."""
    last = last_month(spark, sf, "lineitem", "l_shipdate")
    rows = labels.label_attrition(supplier_month(spark, sf), last=last)
    rows = history.add_history(rows, MONEY, lags=(1, 2), chained=2, slope=True, ratios=True)
    return _round_all(rows, {c: _block_digits(c) for c in rows.columns if "_delta" in c or "_tend" in c or "_ratio" in c})


BLOCK = {"lags": (1, 2), "chained": 2, "slope": True, "ratios": True}


def feature_block_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    """The feature block of a panel laid out by customer: windows over its table neither shuffle nor sort."""
    name = f"panelkit_{uuid.uuid4().hex}"
    panel = panel_files.write_by_customer(supplier_month(spark, sf), name, _scratch(spark, "by-customer"), buckets=8)
    last = panel.agg(F.max(month_ordinal("ym"))).scalar()
    rows = history.add_history(labels.label_attrition(panel, last=last), MONEY, **BLOCK)
    return _round_all(rows, {c: _block_digits(c) for c in rows.columns if "_delta" in c or "_tend" in c or "_ratio" in c})


def arriving_months(spark: SparkSession, sf: str) -> DataFrame:
    """The feature block of a panel whose last three months arrive one by one, the last of them twice."""
    panel = _suppliers(spark, sf)
    months = search.periods(panel)
    store = arrivals.Arrivals(_scratch(spark, "arrivals"), MONEY, BLOCK)
    store.begin(panel.filter(F.col("ym") < months[-3]))
    for month in (*months[-3:], months[-1]):
        store.arrive(panel.filter(F.col("ym") == month))
    rows = store.read(spark)
    return _round_all(rows, {c: _block_digits(c) for c in rows.columns if "_delta" in c or "_tend" in c or "_ratio" in c})


def _block_digits(column: str) -> int:
    if "_delta" in column:
        return 4
    if "_ratio" in column:
        return 8
    return 3 if column == "mprice_tend6" else 5


def history_p95(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["mvalue", "mpurchase"]
    rows = history.scale_by_own_p95(user_day(spark, sf), columns, period="period")
    return _round_all(rows.select(*KEY, *columns), dict.fromkeys(columns, 5))


# the row itself


def intra_row_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = labels.with_tenure(supplier_month(spark, sf))
    return rows.select(
        "id",
        "ym",
        (F.col("ym") % 100).alias("kmes"),
        month_ordinal("ym").alias("ordinal"),
        rounded(snapshot.tenure_normalised("cl", "tenure"), 6).alias("cl_normalised"),
        snapshot.ratio("mprice", "mqty").alias("mprice_per_qty"),
    )


def family_sum(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshot.drop_columns(user_day(spark, sf), ["mvalue", "not_there"])
    money = family(rows)
    rows = snapshot.add_row_sum(snapshot.as_double(rows, money), money)
    rows = snapshot.zero_nulls(rows, matching(rows, "^(m|Visa_m|Master_m)"))
    return _round_all(rows, {"suma_m_visa_master": 4})


def distinct_periods(spark: SparkSession, sf: str) -> DataFrame:
    return supplier_month(spark, sf).select("ym").distinct().orderBy("ym")


def snapshot_union(spark: SparkSession, sf: str) -> DataFrame:
    panel = supplier_month(spark, sf)
    early, late = panel.filter("ym < 199806"), panel.filter("ym >= 199806")
    shifted = late.select(*reversed(late.columns))
    return snapshot.keep_periods(panel_files.stack_snapshots(early, shifted), [199712, 199801, 199806, 200003])


# sampling and canaries


def canary_first_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = sampling.add_canaries(user_day(spark, sf), ratio=0.5, keys=KEY, ignore=KEY)
    rows = sampling.add_canaries(rows, n=sampling.canary_count(5, 3 / 5), keys=KEY, seed=7, kind="uniform")
    made = [c for c in rows.columns if c.startswith("canarito")]
    return _round_all(rows.select(*made, *KEY), dict.fromkeys(made, 6))


def undersample_exact(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.undersample_exact(settle(_with_target(spark, sf)), 0.1, 4177, KEY).select(*KEY, "target")


def undersample_bernoulli(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.undersample_bernoulli(_labelled(spark, sf), 0.05, 4177, KEY).select(*KEY, "label")


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.class_weights(settle(_labelled(spark, sf))).select(*KEY, "label", "weight")


# repair and scaling


def dead_flags(spark: SparkSession, sf: str) -> DataFrame:
    panel = _broken_suppliers(spark, sf)
    both = repair.dead_flags(panel, MONEY).join(
        repair.dead_flags(panel, MONEY, rule="zero_sum").toDF("ym", *[f"zero_{c}" for c in MONEY]), "ym"
    )
    return both.select("ym", *[F.col(c).cast("int").alias(c) for c in both.columns if c != "ym"])


def dead_all_zero(spark: SparkSession, sf: str) -> DataFrame:
    panel = _broken_suppliers(spark, sf)
    return repair.blank_dead_columns(panel, numeric(panel, exclude=["id", "ym"]))


def dead_zero_sum(spark: SparkSession, sf: str) -> DataFrame:
    panel = _broken_suppliers(spark, sf)
    return repair.blank_dead_columns(panel, MONEY, rule="zero_sum")


def dead_month_interpolated(spark: SparkSession, sf: str) -> DataFrame:
    return repair.interpolate_dead_periods(_broken_suppliers(spark, sf), MONEY)


def time_interpolated(spark: SparkSession, sf: str) -> DataFrame:
    return repair.interpolate_zeros(dead_month(supplier_month(spark, sf)), MONEY)


def median_drift(spark: SparkSession, sf: str) -> DataFrame:
    rows = repair.correct_median_drift(_suppliers(spark, sf), ["mprice", "mqty"], 199806)
    return _round_all(rows, {"mprice": 3, "mqty": 4})


def median_drift_reference(spark: SparkSession, sf: str) -> DataFrame:
    rows = repair.correct_median_drift(_suppliers(spark, sf), ["mprice"], 199803, mode="reference")
    return _round_all(rows, {"mprice": 3})


def limit_means(spark: SparkSession, sf: str) -> DataFrame:
    means = scale.limit_means(supplier_month(spark, sf), ("Visa_mdisc", "Master_mtax"))
    return _round_all(means, {"mean_a": 7, "mean_b": 7, "mean_both": 8})


def scale_by_limit(spark: SparkSession, sf: str) -> DataFrame:
    panel = _suppliers(spark, sf)
    rows = scale.scale_by_limit(panel, family(panel), ("Visa_mdisc", "Master_mtax"))
    return _round_all(rows, {"mprice": 4, "mqty": 5})


def deflate(spark: SparkSession, sf: str) -> DataFrame:
    panel = _suppliers(spark, sf)
    # an index growing by half a percent a month, unknown from 2001 on
    months = panel.select("ym").distinct().filter("ym < 200101")
    index = months.withColumn("index", F.lit(1.0) + F.lit(0.005) * (month_ordinal("ym") - 23941))
    return scale.deflate(panel, MONEY, index)


def scale_by_p95(spark: SparkSession, sf: str) -> DataFrame:
    panel = _suppliers(spark, sf)
    return _round_all(scale.scale_by_p95(panel, family(panel)), dict.fromkeys(MONEY, 6))


def scale_by_p95_interpolated(spark: SparkSession, sf: str) -> DataFrame:
    panel = settle(user_day(spark, sf))
    rows = scale.scale_by_p95(panel, family(panel), "period", "cont")
    return _round_all(rows, dict.fromkeys(family(panel), 6))


def period_moments(spark: SparkSession, sf: str) -> DataFrame:
    rows = scale.period_moments(supplier_month(spark, sf), ["mprice", "cl"])
    return _round_all(rows, {"mprice_mean": 7, "mprice_std": 5, "cl_mean": 7, "cl_std": 6})


PROJECTION = {"mprice": (-0.61, -0.42), "cl": (0.18, -0.77), "mqty": (0.25, 0.36), "mprice_lag_1": (0.14, -0.33)}


def projection_terms(spark: SparkSession, sf: str) -> DataFrame:
    rows = history.add_history(_suppliers(spark, sf), ["mprice"], lags=(1,))
    rows = scale.projection_terms(rows, PROJECTION)
    return _round_all(rows.select("id", "ym", "ppr_term_1", "ppr_term_2"), {"ppr_term_1": 6, "ppr_term_2": 6})


def class_quantile_global(spark: SparkSession, sf: str) -> DataFrame:
    rows = scale.class_distance(settle(_labelled(spark, sf)), ["mvalue", "mpurchase"], TRAIN_DAYS, period="period")
    made = [c for c in rows.columns if c.startswith("dist_")]
    return _round_all(rows.select(*KEY, *made), dict.fromkeys(made, 5))


def class_quantile_rolling(spark: SparkSession, sf: str) -> DataFrame:
    rows = scale.class_distance_rolling(settle(_labelled(spark, sf)), ["mvalue", "mpurchase"], period="period")
    made = [c for c in rows.columns if c.startswith("dist_")]
    return _round_all(rows.select(*KEY, *made), dict.fromkeys(made, 5))


# importances: each part stands for a feature, each line number for a seed, every twentieth part for a canary


def part_importances(spark: SparkSession, sf: str) -> DataFrame:
    part = F.col("l_partkey")
    name = F.when(part % 20 == 0, F.format_string("canarito_%03d", part)).otherwise(F.format_string("part_%d", part))
    return (
        table(spark, sf, "lineitem")
        .groupBy(name.alias("feature"), F.col("l_linenumber").alias("seed"))
        .agg(
            F.round(F.sum("l_extendedprice"), 4).alias("importance"),
            F.round(F.sum("l_quantity"), 4).alias("cover"),
            F.count(F.lit(1)).alias("frequency"),
        )
    )


def _mean_importances(spark: SparkSession, sf: str) -> DataFrame:
    return settle(selection.mean_importance(settle(part_importances(spark, sf))))


def importance_report(spark: SparkSession, sf: str) -> DataFrame:
    means = _mean_importances(spark, sf)
    return _round_all(selection.extremes(means), {"importance": 4})


def importance_detail(spark: SparkSession, sf: str) -> DataFrame:
    rows = selection.importance_detail(part_importances(spark, sf), ["importance", "cover", "frequency"])
    return _round_all(rows, {"importance": 6, "cover": 6, "frequency": 6})


def canary_selection(spark: SparkSession, sf: str) -> DataFrame:
    means = _mean_importances(spark, sf)
    return _round_all(selection.selected_features(means, 0.95), {"importance": 4})


def canary_narrowed(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of the user panel that beat the canaries, as rows of key, feature and value. A column's importance is the
    number of its positive values, a canary's the number of rows on every second, third or fourth day."""
    panel = settle(user_day(spark, sf))
    columns = ["cevents", *family(panel)]
    measured = {c: F.count_if(F.col(c) > 0) for c in columns} | {f"canarito_{k}": F.count_if(F.col("period") % k == 0) for k in (2, 3, 4)}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_{c}").cast("double").alias("importance")) for c in measured]))
    importances = settle(panel.agg(*[e.alias(f"_{c}") for c, e in measured.items()]).select(pairs.alias("e")).select("e.*"))
    narrow = selection.select_by_canaries(panel, importances, 0.5, KEY)
    kept = [c for c in narrow.columns if c not in KEY]
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in kept]))
    return narrow.select(*KEY, values.alias("e")).select(*KEY, "e.feature", "e.value")


# gain


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return hash_scores(settle(_labelled(spark, sf)))


def _curve(spark: SparkSession, sf: str) -> DataFrame:
    """Gain curves of the five replicates."""
    return gain.gain_curve(_scored(spark, sf), keys=KEY, group=["replicate"])


def gain_curve(spark: SparkSession, sf: str) -> DataFrame:
    one = hash_scores(_labelled(spark, sf), (1,))
    return gain.gain_curve(one, keys=KEY).select(*KEY, "label", "gain", "gain_acum", "rank")


def gain_peak(spark: SparkSession, sf: str) -> DataFrame:
    curve = _curve(spark, sf)
    mean = gain.peak_gain(curve, ["replicate"]).withColumnRenamed("value", "mean_gain")
    top = gain.peak_gain(curve, ["replicate"], mode="max").select("replicate", F.col("value").alias("max_gain"))
    return _round_all(mean.join(top, "replicate"), {"mean_gain": 6})


def gain_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    return gain.gain_points(_scored(spark, sf), CUTOFFS, keys=KEY, group=["replicate"])


def gain_best_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    points = gain.gain_at(_curve(spark, sf), CUTOFFS, ["replicate"])
    return gain.best_cutoff(points, ["replicate"], 300, 1900)


def gain_smoothed(spark: SparkSession, sf: str) -> DataFrame:
    points = gain.gain_at(_curve(spark, sf), FINE_CUTOFFS, ["replicate"])
    return _round_all(gain.smoothed(points, ["replicate"]), {"smooth": 6})


def update_join_gain(spark: SparkSession, sf: str) -> DataFrame:
    truth = settle(_labelled(spark, sf))
    flagged = gain.mark_first(hash_scores(truth), 500, keys=KEY, group=["replicate"])
    return gain.campaign_gain(truth, flagged, KEY, group=["replicate"])


def ensemble_mean(spark: SparkSession, sf: str) -> DataFrame:
    rows = gain.ensemble_mean(_scored(spark, sf), KEY, carry=["label"])
    return _round_all(rows, {"score": 9})


def score_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = gain.score_summary(gain.ensemble_mean(_scored(spark, sf), KEY))
    return _round_all(rows, {"min_score": 9, "max_score": 9})


def replicate_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return gain.gain_matrix(gain.gain_at(_curve(spark, sf), CUTOFFS, ["replicate"]), CUTOFFS)


def mean_gains(spark: SparkSession, sf: str) -> DataFrame:
    rows = gain.mean_gains(gain.gain_at(_curve(spark, sf), CUTOFFS, ["replicate"]))
    best = gain.best_cutoff(rows).select("best_cutoff").scalar()
    return _round_all(rows.withColumn("best", (F.col("cutoff") == best).cast("int")), {"total": 6})


def experiment_ledger(spark: SparkSession, sf: str) -> DataFrame:
    points = gain.gain_at(_curve(spark, sf), CUTOFFS, ["replicate"])
    path = _scratch(spark, "ledger")
    reports.append_ledger(points, CUTOFFS, "first", path)
    reports.append_ledger(points, CUTOFFS, "second", path)
    schema = ", ".join(f"e{c} double" for c in CUTOFFS) + ", experiment string"
    return _round_all(reports.read_table(spark, path, schema, "\t"), {f"e{c}": 6 for c in CUTOFFS})


def consensus_submission(spark: SparkSession, sf: str) -> DataFrame:
    curve = _curve(spark, sf)
    means = gain.mean_gains(gain.gain_at(curve, CUTOFFS, ["replicate"]))
    return gain.consensus_submission(curve, means.agg(F.max("total")).scalar(), keys=KEY)


# search: each customer stands for a trial


def customer_trials(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("trial_number"), F.col("c_acctbal").alias("value"), F.col("c_nationkey").alias("nation")
    )


def trial_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _round_all(search.trial_stats(customer_trials(spark, sf)), {"mean": 4})


def top_trials(spark: SparkSession, sf: str) -> DataFrame:
    return search.top_trials(customer_trials(spark, sf), 5)


def best_trial(spark: SparkSession, sf: str) -> DataFrame:
    return search.best_trial(customer_trials(spark, sf))


def trial_log(spark: SparkSession, sf: str) -> DataFrame:
    """Trials written to the JSON log in two batches, read back, and ranked."""
    rows = customer_trials(spark, sf).select(
        F.col("trial_number").cast("int"),
        F.create_map(F.lit("nation"), F.col("nation").cast("double")).alias("params"),
        "value",
        F.lit("2024-01-01T00:00:00").alias("datetime"),
        F.lit("COMPLETE").alias("state"),
        F.struct(
            F.array(F.lit(1)).alias("semilla"),
            F.array(F.lit(202101)).alias("mes_train"),
            F.array(F.lit(202104)).alias("mes_validacion"),
        ).alias("configuracion"),
    )
    path = _scratch(spark, "trials")
    trials.append_trials(rows.filter("value < 5000"), path)
    trials.append_trials(rows.filter("value >= 5000"), path)
    return trials.read_trials(spark, path).select(
        "trial_number", "value", F.col("params")["nation"].alias("nation"), "state",
        F.col("configuracion.mes_train")[0].alias("train_from"),
    )


def search_space(spark: SparkSession, sf: str) -> DataFrame:
    draws = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("trial_number"), *[hash_uniform(p, "c_custkey").alias(p) for p in search.SEARCH_RANGES]
    )
    rows = table(spark, sf, "lineitem").agg(F.count(F.lit(1))).scalar()
    decoded = search.decode_trials(draws, rows)
    decoded = decoded.withColumn("rejected", F.col("rejected").cast("int"))
    return _round_all(decoded, {"learning_rate": 9, "feature_fraction": 9})


def rolling_schedule(spark: SparkSession, sf: str) -> DataFrame:
    return search.rolling_schedule(user_day(spark, sf), "period")


# clusters


def _points(spark: SparkSession, sf: str) -> DataFrame:
    points = clusters.standardize(customer_points(spark, sf), ["x", "y"])
    return settle(_round_all(points, {"x": 6, "y": 6}))


def zscore(spark: SparkSession, sf: str) -> DataFrame:
    return _points(spark, sf)


EPS, MIN_POINTS = 0.12, 12


def density_core(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.density_core(_points(spark, sf), EPS, MIN_POINTS)


def core_contingency(spark: SparkSession, sf: str) -> DataFrame:
    flags = clusters.density_core(_points(spark, sf), EPS, MIN_POINTS)
    segments = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    values = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return clusters.contingency(flags.join(segments, "id"), "core", "c_mktsegment", values)


def axis_histogram(spark: SparkSession, sf: str) -> DataFrame:
    rows = _points(spark, sf).join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment"), "id"
    )
    return clusters.axis_histogram(rows, "y", "c_mktsegment", -2.0, 2.0, 16)


def density_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.density_clusters(_points(spark, sf), EPS, MIN_POINTS)


def cluster_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters against market segments."""
    found = clusters.density_clusters(_points(spark, sf), EPS, MIN_POINTS).select("id", "cluster")
    segments = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    values = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return clusters.contingency(found.join(segments, "id"), "cluster", "c_mktsegment", values)


def cluster_density(spark: SparkSession, sf: str) -> DataFrame:
    """Density along an axis within each cluster."""
    return clusters.axis_histogram(clusters.density_clusters(_points(spark, sf), EPS, MIN_POINTS), "y", "cluster", -2.0, 2.0, 16)


def pca_project(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.pca_project(table(spark, sf, "embeddings"), "embedding").select("vec_id", "label", "pc1", "pc2")


def projected_clusters(spark: SparkSession, sf: str) -> DataFrame:
    projected = settle(pca_project(spark, sf))
    return clusters.density_clusters(projected, 0.8, 20, "pc1", "pc2", "vec_id")


# files


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/panelkit-files/{name}-{uuid.uuid4().hex}"


def panel_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Panel to gzipped CSV, back with a schema, to parquet by month, and back."""
    rows = supplier_month(spark, sf)
    text, columnar = _scratch(spark, "panel-csv"), _scratch(spark, "panel")
    rows.write.option("header", True).option("compression", "gzip").csv(text)
    panel_files.write_panel(panel_files.read_panel_csv(spark, text, rows.schema), columnar)
    return panel_files.require_unique_keys(panel_files.read_panel(spark, columnar))


def predictions_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Replicates appended as TSV and read back."""
    curve = _curve(spark, sf).select(
        "id", F.col("period").alias("ym"), F.round("score", 6).alias("score"), "gain_acum", "replicate"
    )
    path = _scratch(spark, "predictions")
    reports.append_predictions(curve.filter("replicate <= 2"), path)
    reports.append_predictions(curve.filter("replicate > 2"), path)
    return reports.read_predictions(spark, path)


def importances_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    means = _mean_importances(spark, sf)
    path = _scratch(spark, "importances")
    reports.write_importances(_round_all(means, {"importance": 4}), path)
    return reports.read_importances(spark, path)


def curve_report(spark: SparkSession, sf: str) -> DataFrame:
    """Gain curve written as CSV, and its best point."""
    one = gain.gain_curve(hash_scores(_labelled(spark, sf), (1,)), keys=KEY)
    return reports.write_curve(one, _scratch(spark, "curve"), high=30_000)


def submission_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    marked = gain.mark_first(hash_scores(_labelled(spark, sf), (1,)), 1100, keys=KEY)
    path = _scratch(spark, "submission")
    reports.write_submission(marked, path)
    back = reports.read_table(spark, path, "id bigint, Predicted int")
    return back.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("Predicted").alias("predicted"))


# models


def _features(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled user days with lags and deltas, settled because training reads them many times."""
    rows = _with_target(spark, sf)
    money = family(rows)
    return settle(history.add_history(rows, [*money, "cevents"], period="period", lags=(1, 2), chained=2), by="period")


def _feature_names(rows: DataFrame) -> list[str]:
    return numeric(rows, exclude=["target", "id"])


def leaf_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = _features(spark, sf)
    return models.forest_leaf_features(
        rows.select("id", "target", *_feature_names(rows)), _feature_names(rows), TRAIN_DAYS, period="period"
    )


def overfit_importance(spark: SparkSession, sf: str) -> DataFrame:
    rows = sampling.add_canaries(_features(spark, sf), n=5, keys=KEY)
    found = models.overfit_importance(
        rows, _feature_names(rows), TRAIN_DAYS, SEEDS, 0.5, DEEP, period="period", parallelism=SIDE_BY_SIDE)
    return selection.mean_importance(found)


def seed_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    rows = _features(spark, sf)
    scored = models.score_periods(
        rows, _feature_names(rows), TRAIN_DAYS, [24, 25, 26], SEEDS, FAST, 0.5, period="period", parallelism=SIDE_BY_SIDE
    )
    return gain.gain_curve(scored, keys=KEY)


def leaf_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The leaves of every row as positions in one sparse vector."""
    rows = _features(spark, sf)
    found = models.forest_leaf_vector(rows, _feature_names(rows), TRAIN_DAYS, period="period")
    ones = F.expr("filter(sequence(0, size(_dense) - 1), i -> _dense[i] = 1)")
    return found.withColumn("_dense", vector_to_array("leaves")).select(*KEY, F.size("_dense").alias("size"), ones.alias("positions"))


def _rolling(spark: SparkSession, sf: str) -> DataFrame:
    rows = _features(spark, sf)
    # weeks instead of days, so that a period has enough rows to train on
    weekly = settle(rows.withColumn("week", F.expr("cast(period div 7 as int)")), by="week")
    return models.rolling_scores(weekly, _feature_names(rows), SEEDS, ROLLING, target="target", period="week", parallelism=SIDE_BY_SIDE)


def rolling_oof(spark: SparkSession, sf: str) -> DataFrame:
    """Every row with its score by models of the weeks before."""
    return _rolling(spark, sf).select(*KEY, "label", "score_rolling")


def rolling_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Which rows have a score by models of the weeks before."""
    return _rolling(spark, sf).select(*KEY, "label", F.col("score_rolling").isNotNull().alias("scored"))


def _tuned(spark: SparkSession, sf: str) -> DataFrame:
    rows = _features(spark, sf)
    log = models.tune_by_gain(
        rows, _feature_names(rows), TRAIN_DAYS, [24], SEEDS[:1], TRIALS, _scratch(spark, "search"),
        share=0.5, ranges=SHORT, half_window=50, period="period", parallelism=SIDE_BY_SIDE,
    )
    p = F.col("params")
    return log.select(
        "trial_number", "state", F.rint(F.pow(F.lit(2.0), p["num_iterations_exp"])).cast("bigint").alias("num_iterations"),
        F.rint(F.pow(F.lit(2.0), p["num_leaves_exp"])).cast("bigint").alias("num_leaves"),
        (F.col("value") == search.REJECTED).cast("int").alias("rejected"), F.col("value").alias("gain"),
    )


def tuned_gain(spark: SparkSession, sf: str) -> DataFrame:
    """The trials of a search with the gain of each."""
    return _tuned(spark, sf)


def tuned_trials(spark: SparkSession, sf: str) -> DataFrame:
    """The trials of a search, and which were rejected."""
    return _tuned(spark, sf).drop("gain")


def _future(spark: SparkSession, sf: str) -> DataFrame:
    rows = _features(spark, sf)
    scored = models.score_periods(
        rows, _feature_names(rows), TRAIN_DAYS, [29], SEEDS, FAST, 0.5, period="period", parallelism=SIDE_BY_SIDE)
    path = _scratch(spark, "future")
    reports.write_scores(scored, path)
    return reports.read_table(spark, path, "id bigint, score double")


def future_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of a period that is not known yet, written as CSV and read back."""
    return _future(spark, sf)


def future_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Who is scored in a period that is not known yet."""
    return _future(spark, sf).select("id")


def _ensemble(spark: SparkSession, sf: str) -> tuple[models.Ensemble, DataFrame]:
    rows = _features(spark, sf)
    train = models.training_rows(rows, TRAIN_DAYS, 0.5, SEEDS[0], period="period")
    return models.fit_ensemble(train, _feature_names(rows), SEEDS, FAST, parallelism=SIDE_BY_SIDE), rows


def gains_by_trees(spark: SparkSession, sf: str) -> DataFrame:
    """The validation day's gain after every tree of an ensemble, and which number of trees is chosen."""
    ensemble, rows = _ensemble(spark, sf)
    found = trees.gains_by_trees(ensemble, rows.filter("period = 24"), ensemble.stored(), ensemble.key, keys=KEY, half_window=50)
    gains = settle(found)
    return gains.withColumn("chosen", (F.col("iteration") == trees.chosen_trees(gains)).cast("int"))


def model_importances(spark: SparkSession, sf: str) -> DataFrame:
    """Mean shares of gain, cover and splits of every feature over the models of an ensemble."""
    ensemble, _ = _ensemble(spark, sf)
    return selection.importance_detail(ensemble.split_importances())


def shuffled_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers in a reproducible random order, numbered along it."""
    rows = sampling.shuffled(_suppliers(spark, sf).select("id", "ym"), 4177)
    return running(rows, [hash_bits(4177, "id", "ym"), F.col("id"), F.col("ym")], rank="place")



# whole studies


def _setup(**changes: object) -> study.Setup:
    usual = dict(
        train=TRAIN_DAYS, valid=[23], test=[25, 26], future=[29], seeds=SEEDS[:4], share=0.5, period="period",
        yyyymm=False, drop=["not_there"], params=FAST, half_window=50, parallelism=SIDE_BY_SIDE,
    )
    return study.Setup(**{**usual, **changes})


def fixed_study(spark: SparkSession, sf: str) -> DataFrame:
    return study.fixed_study(settle(user_day(spark, sf)), _setup())


REPLICATE_CUTOFFS = [10, 50, 100]


def replicate_study(spark: SparkSession, sf: str) -> DataFrame:
    """Gain per replicate and cutoff; the row without a replicate holds the means."""
    matrix, means, _ = study.replicate_study(settle(user_day(spark, sf)), _setup(), 2, REPLICATE_CUTOFFS)
    wide = means.agg(*[F.max(F.when(F.col("cutoff") == c, F.col("total"))).alias(f"e{c}") for c in REPLICATE_CUTOFFS])
    return matrix.unionByName(wide, allowMissingColumns=True)


def replicate_submission(spark: SparkSession, sf: str) -> DataFrame:
    """The customers marked up to the rank whose gain is nearest to the best mean of the replicates."""
    return study.replicate_study(settle(user_day(spark, sf)), _setup(), 2, REPLICATE_CUTOFFS)[2]


def search_study(spark: SparkSession, sf: str) -> DataFrame:
    """The test days' gain curve; the rows without a rank are the future's scores."""
    quick = models.TreeParams(iterations=2, leaves=32, rows_per_leaf=1)
    curve, future = study.search_study(
        settle(user_day(spark, sf)), _setup(seeds=SEEDS[:1]), _scratch(spark, "study"), TRIALS, quick,
        {"mvalue": (0.3, -0.5), "cevents_lag_1": (0.6, 0.1)}, ranges=SHORT,
    )
    return curve.unionByName(future, allowMissingColumns=True)


REGISTERED: dict[str, Query] = {
    f.__name__: f
    for f in (
        label_counts, label_counts_suppliers, label_counts_customers, label_pivot, label4_counts, label4_rows, target_modes,
        cluster_class_tenure, tenure_modes,
        lag_delta_chained, lag_delta_anchored, lag_calendar, trend_window, trend_window_nulls, window_ratios,
        feature_block, feature_block_by_customer, arriving_months, history_p95,
        intra_row_features, family_sum, distinct_periods, snapshot_union,
        canary_first_order, undersample_exact, undersample_bernoulli, class_weights,
        dead_flags, dead_all_zero, dead_zero_sum, dead_month_interpolated, time_interpolated,
        median_drift, median_drift_reference,
        limit_means, scale_by_limit, deflate, scale_by_p95, scale_by_p95_interpolated, period_moments,
        projection_terms, class_quantile_global, class_quantile_rolling,
        importance_report, importance_detail, canary_selection, canary_narrowed,
        gain_curve, gain_peak, gain_cutoffs, gain_best_cutoff, gain_smoothed, update_join_gain, ensemble_mean,
        score_summary, replicate_matrix, mean_gains, experiment_ledger, consensus_submission,
        trial_stats, top_trials, best_trial, trial_log, search_space, rolling_schedule,
        zscore, density_core, core_contingency, axis_histogram,
        panel_roundtrip, predictions_roundtrip, importances_roundtrip, curve_report, submission_roundtrip,
        leaf_features, leaf_vectors, overfit_importance, seed_ensemble, rolling_oof, rolling_scored, tuned_gain, tuned_trials,
        future_scores, future_customers, gains_by_trees, model_importances, shuffled_rows, cluster_classes, cluster_density,
        pca_project, density_clusters, projected_clusters,
        fixed_study, replicate_study, replicate_submission, search_study,
    )
}
