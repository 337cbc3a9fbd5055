import random

from pyspark.sql import functions as F

from panelkit.operators import gain


def _scored(spark, rows):
    return spark.createDataFrame(rows, "id int, ym int, label string, score double")


def test_curve_and_ties(spark):
    rows = [(3, 1, "BAJA+2", 0.5), (1, 1, "CONTINUA", 0.5), (2, 2, None, 0.5), (2, 1, "BAJA+1", 0.9)]
    curve = gain.gain_curve(_scored(spark, rows)).orderBy("rank").collect()
    assert [(r["id"], r["ym"]) for r in curve] == [(2, 1), (1, 1), (2, 2), (3, 1)]
    assert [r["gain"] for r in curve] == [-2, -2, -2, 78]
    assert [r["gain_acum"] for r in curve] == [-2, -4, -6, 72]


def test_last_value_is_the_total(spark):
    rng = random.Random(2)
    rows = [(i, 1, rng.choice(["BAJA+2", "CONTINUA", None]), rng.random()) for i in range(500)]
    curve = gain.gain_curve(_scored(spark, rows))
    total = sum(78 if r[2] == "BAJA+2" else -2 for r in rows)
    assert curve.orderBy(F.desc("rank")).first()["gain_acum"] == total


def test_peak_window_is_clipped(spark):
    rows = [(i, 1, "BAJA+2" if i in (2, 5) else "CONTINUA", 1 - i / 10) for i in range(8)]
    curve = gain.gain_curve(_scored(spark, rows))
    acc = [r["gain_acum"] for r in curve.orderBy("rank").collect()]
    peak = acc.index(max(acc))
    near = acc[max(0, peak - 3) : peak + 4]
    got = gain.peak_gain(curve, half_window=3).first()
    assert got["peak_rank"] == peak + 1 and got["value"] == sum(near) / len(near)
    assert gain.peak_gain(curve, mode="max").first()["value"] == max(acc)


def test_peak_on_binary_truth(spark):
    rows = [(1, 1, 1, 0.9), (2, 1, 0, 0.8)]
    df = spark.createDataFrame(rows, "id int, ym int, target int, score double")
    curve = gain.gain_curve(df, label="target", positive=1)
    assert gain.peak_gain(curve, mode="max").first()["value"] == 78.0


def test_best_cutoff_is_the_first_maximum(spark):
    points = spark.createDataFrame([(100, 5), (150, 9), (200, 9), (40000, 99)], "cutoff int, total int")
    best = gain.best_cutoff(points, high=30000).first()
    assert (best["best_total"], best["best_cutoff"]) == (9, 150)


def test_smoothing_reaches_further_ahead(spark):
    points = spark.createDataFrame([(i, float(i)) for i in range(1, 31)], "cutoff int, total double")
    got = {r["cutoff"]: r["smooth"] for r in gain.smoothed(points).collect()}
    assert got[9] is None and got[10] == sum(range(1, 21)) / 20 and got[20] == 20.5 and got[21] is None


def test_missing_cutoffs_are_skipped_in_means(spark):
    points = spark.createDataFrame([(1, 10, 4), (2, 10, 8), (1, 20, 6)], "replicate int, cutoff int, total int")
    assert {r["cutoff"]: r["total"] for r in gain.mean_gains(points).collect()} == {10: 6.0, 20: 6.0}
    wide = gain.gain_matrix(points, [10, 20]).orderBy("replicate").collect()
    assert [(r["e10"], r["e20"]) for r in wide] == [(4, 6), (8, None)]
    row = gain.ledger_row(points, [10, 20], "x").first()
    assert (row["e10"], row["e20"], row["experiment"]) == (6.0, 6.0, "x")


def test_consensus(spark):
    rows = [(1, 1, 1, 78), (1, 2, 2, 76), (2, 3, 1, -2), (2, 1, 2, 75)]
    curve = spark.createDataFrame(rows, "replicate int, id int, rank int, gain_acum int")
    got = gain.consensus_submission(curve, F.lit(75.4)).orderBy("rank").collect()
    assert [(r["id"], r["predicted"]) for r in got] == [(3, 1), (1, 1)]
    got = gain.consensus_submission(curve, F.lit(77.0)).orderBy("rank").collect()
    assert [(r["id"], r["predicted"]) for r in got] == [(1, 1), (2, 0)]


def test_campaign_gain(spark):
    truth = spark.createDataFrame([(1, 1, "BAJA+2"), (2, 1, None), (3, 1, "BAJA+2")], "id int, ym int, label string")
    flags = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 1, 0)], "id int, ym int, predicted int")
    assert gain.campaign_gain(truth, flags).first()["total"] == 780000 - 20000
