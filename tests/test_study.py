from panelkit.operators import models
from panelkit.plans import study


def test_replicates_go_on_where_they_stopped(spark, tmp_path, monkeypatch):
    rows = [(i, m, float((i * 7 + m) % 13), float(i % 5)) for m in range(1, 8) for i in range(60) if not (i % 6 == 0 and m > 3 + i % 4)]
    panel = spark.createDataFrame(rows, "id int, ym int, mbalance double, ctrx double")
    setup = study.Setup([1, 2, 3], [], [5], seeds=(1, 2, 3, 4), share=0.9, yyyymm=False, store=str(tmp_path / "fits"),
                        params=models.TreeParams(iterations=2, leaves=4, rows_per_leaf=5), parallelism=2)
    fits, whole = [], models.TreeParams.learner
    monkeypatch.setattr(models.TreeParams, "learner", lambda self, seed, label: fits.append(seed) or whole(self, seed, label))

    def run():
        return [sorted(map(str, df.collect())) for df in study.replicate_study(panel, setup, 2, [5, 20])]

    first = run()
    assert sorted(fits) == [1, 2, 3, 4]
    assert run() == first and len(fits) == 4
    assert len(first[0]) == 2 and len(first[1]) == 2 and first[2]
