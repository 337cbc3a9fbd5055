"""A feature store that a new month extends without reading the old ones.

Under a folder lie four tables, each with a folder per period: `panel` (the rows as they came), `labels` (id, label),
`features` (the rows with their history), and `tail` (the last snapshots of every customer up to a period). When a month
arrives, its features need it and the tail before it; its labels need the periods of the horizon, whose rows may be
labelled anew. Periods are replaced one by one (dynamic partition overwrite), so an arrival that was cut short, or whose
rows were corrected, is simply repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.functions.columns import ordinal
from panelkit.functions.durable import settle
from panelkit.operators import history, labels

UPTO = "_upto"


@dataclass(frozen=True)
class Arrivals:
    """The store's folder, the columns with a history, and the settings of add_history."""

    folder: str
    columns: Sequence[str]
    settings: dict = field(default_factory=dict)
    id: str = "id"
    period: str = "ym"
    yyyymm: bool = True
    horizon: int = 2

    @property
    def depth(self) -> int:
        """Snapshots before a row that its features may look at."""
        s = self.settings
        if s.get("calendar"):
            raise ValueError("lags over the calendar need no tail; read the periods they look at")
        window = s.get("window", 6) - 1 if any(s.get(k) for k in ("slope", "extremes", "ratios")) else 0
        return max([window, s.get("chained", 0), *s.get("lags", ()), *s.get("anchored", ())])

    def _write(self, df: DataFrame, name: str, by: str) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by)
        writer.parquet(f"{self.folder.rstrip('/')}/{name}")

    def _read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder.rstrip('/')}/{name}")

    def _near(self, at: int, latest: int) -> list[int]:
        """The period, and those before it whose labels the latest one before left open: the horizon's, and any in which
        nobody was seen."""
        if not self.yyyymm:
            return list(range(latest + 1 - self.horizon, at + 1))
        number = lambda p: p // 100 * 12 + p % 100 - 1
        return [m // 12 * 100 + m % 12 + 1 for m in range(number(latest) + 1 - self.horizon, number(at) + 1)]

    def _labelled(self, rows: DataFrame, last: int) -> DataFrame:
        end = last // 100 * 12 + last % 100 if self.yyyymm else last
        return labels.label_attrition(rows.select(self.id, self.period), self.id, self.period, self.yyyymm, self.horizon, last=end)

    def _features(self, rows: DataFrame) -> DataFrame:
        return history.add_history(rows, self.columns, self.id, self.period, yyyymm=self.yyyymm, **self.settings)

    def _tail(self, rows: DataFrame, at: int) -> DataFrame:
        latest = Window.partitionBy(self.id).orderBy(F.desc(self.period))
        kept = rows.withColumn("_back", F.row_number().over(latest)).filter(F.col("_back") <= max(1, self.depth)).drop("_back")
        return kept.withColumn(UPTO, F.lit(int(at)))

    def begin(self, panel: DataFrame) -> None:
        """Build the store from a panel of at least one period."""
        rows = settle(panel)
        last = rows.agg(F.max(self.period)).first()[0]
        if last is None:
            raise ValueError("a store begins with at least one period")
        self._write(rows, "panel", self.period)
        self._write(self._labelled(rows, last), "labels", self.period)
        self._write(self._features(rows), "features", self.period)
        self._write(self._tail(rows, last), "tail", UPTO)

    def _known(self, spark: SparkSession) -> list[int]:
        """The panel's periods, from the names of its folders."""
        return sorted(r[0] for r in self._read(spark, "panel").select(self.period).distinct().collect())

    def near_panel(self, spark: SparkSession, at: int) -> DataFrame:
        """Ids of the periods whose labels the period decides; other periods' folders aren't read."""
        latest = max((p for p in self._known(spark) if p < at), default=at)
        return self._read(spark, "panel").filter(F.col(self.period).isin(self._near(at, latest))).select(self.id, self.period)

    def tail_before(self, spark: SparkSession, at: int) -> DataFrame:
        """The last snapshots of every customer before the period."""
        tail = self._read(spark, "tail")
        # the folders' names alone
        known = [r[0] for r in tail.select(UPTO).distinct().collect() if r[0] < at]
        if not known:
            raise ValueError(f"no tail before {at}: begin the store with an earlier period")
        return tail.filter(F.col(UPTO) == max(known)).drop(UPTO)

    def arrive(self, rows: DataFrame) -> None:
        """Add the rows of one period, the latest so far, or replace that one's."""
        spark, new = rows.sparkSession, settle(rows)
        at = new.agg(F.min(self.period), F.max(self.period)).first()
        if at[0] is None or at[0] != at[1]:
            raise ValueError("rows of exactly one period arrive at a time")
        at = at[0]
        latest = max(self._known(spark), default=at)
        if latest > at:
            raise ValueError(f"{at} arrives after {latest}; later periods would keep its old self in their histories")
        with_tail = settle(self.tail_before(spark, at).unionByName(new))
        self._write(new, "panel", self.period)
        self._write(self._features(with_tail).filter(F.col(self.period) == at), "features", self.period)
        self._write(self._tail(with_tail, at), "tail", UPTO)
        self._write(self._labelled(self.near_panel(spark, at), at), "labels", self.period)

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows with their label and history."""
        known = self._read(spark, "labels").select(self.id, self.period, "label")
        return self._read(spark, "features").join(known, [self.id, self.period])
