"""Token counts kept as delta-maintained rollups (operator 7).

Built-in functions only. A store is a folder with signed totals per source, language and tokenizer version, a table for
each batch, and a log of manifests. The newest manifest names the table of every batch, so a commit appears at once, when its
manifest does: readers never see half of it, and what a lost driver left behind is in no manifest. A batch that is
committed again takes the place of its earlier self, or is left out if it was folded into others, so a repeated commit
changes nothing; totals are the sum over all batches.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.llm.text import n_words

KEYS = ("source", "lang", "tokenizer")


def _runs(text: Column) -> Column:
    pattern = "[\\p{L}\\p{N}]+|[^\\x20\\x09-\\x0D\\p{L}\\p{N}]"
    return F.coalesce(F.regexp_count(F.col(text), F.lit(pattern)), F.lit(0)).cast("long")


#: tokenizer version: tokens of a text column; null texts have none
TOKENIZERS = {"blanks-1": n_words, "runs-2": _runs}


def counted(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens of each row."""
    return docs.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), TOKENIZERS[tokenizer](text).alias("n_tokens"))


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(F.lit(1).alias("sign"), *KEYS, "n_tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(F.lit(-1).alias("sign"), *KEYS, "n_tokens")


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts that change: the old ones out, the new ones in. Both have the rows of the same documents."""
    return deletes(old).unionByName(inserts(new))


ROWS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


class Log:
    """The manifests of a store, numbered; each holds the tables by batch, and the batches that were folded into others."""

    def __init__(self, spark: SparkSession, store: str):
        self.spark, self.store = spark, store.rstrip("/")
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(self.store).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _name(self, version: int):
        return self.path(f"{self.store}/_log/{version:012d}.json")

    def newest(self) -> tuple[int, dict]:
        folder = self.path(f"{self.store}/_log")
        if not self.files.exists(folder):
            return 0, {"batches": {}, "folded": []}
        version = max((int(f.getPath().getName()[:12]) for f in self.files.listStatus(folder) if f.getPath().getName().endswith(".json")), default=0)
        if not version:
            return 0, {"batches": {}, "folded": []}
        text = self.spark.read.option("wholetext", True).text(self._name(version).toString()).first()[0]
        return version, json.loads(text)

    def publish(self, version: int, manifest: dict) -> bool:
        """Write the manifest of this number; False if another commit was first. It appears under its name once whole."""
        draft = self.path(f"{self.store}/_log/{uuid.uuid4().hex}.draft")
        out = self.files.create(draft)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        return not self.files.exists(self._name(version)) and self.files.rename(draft, self._name(version))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def commit(store: str, batch: int, changes: DataFrame) -> None:
    """Add the signed rows of a batch (sign, source, lang, tokenizer, n_tokens) to the store, at most once.

    Rows are added up before they are shuffled. A batch that is committed again, as after a lost driver, takes the place
    of its earlier self; one that compact has folded is there already and is left out. Null keys are keys of their own,
    null counts count as 0 tokens of one document. A batch without rows is an empty table.
    """
    log = Log(changes.sparkSession, store)
    if int(batch) in log.newest()[1]["folded"]:
        return
    table = f"batch-{int(batch)}-{uuid.uuid4().hex}"
    signed = changes.select(*KEYS, F.col("sign").cast("long").alias("n_docs"),
                            (F.col("sign") * F.coalesce("n_tokens", F.lit(0))).cast("long").alias("n_tokens"))
    _summed(signed).write.parquet(f"{log.store}/{table}")
    while True:
        version, known = log.newest()
        if int(batch) in known["folded"]:
            return
        if log.publish(version + 1, {**known, "batches": {**known["batches"], str(int(batch)): table}}):
            return


def _tables(spark: SparkSession, log: Log, batches: dict[str, str]) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], ROWS)
    return spark.read.schema(ROWS).parquet(*[f"{log.store}/{t}" for t in batches.values()])


def totals(spark: SparkSession, store: str) -> DataFrame:
    """Documents and tokens per source, language and tokenizer version; keys with neither are left out."""
    log = Log(spark, store)
    return _summed(_tables(spark, log, log.newest()[1]["batches"])).filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))


def compact(spark: SparkSession, store: str, target: str, through: int) -> None:
    """Copy a store with all batches up to `through` folded into one; these can't be committed to the copy again."""
    log, copy = Log(spark, store), Log(spark, target)
    known = log.newest()[1]
    old = {b: t for b, t in known["batches"].items() if int(b) <= through}
    later = {b: t for b, t in known["batches"].items() if int(b) > through}
    names = {str(through): f"folded-{uuid.uuid4().hex}", **{b: f"batch-{b}-{uuid.uuid4().hex}" for b in later}}
    _summed(_tables(spark, log, old)).write.parquet(f"{copy.store}/{names[str(through)]}")
    for b, t in later.items():
        _tables(spark, log, {b: t}).write.parquet(f"{copy.store}/{names[b]}")
    folded = sorted({*known["folded"], *map(int, old), int(through)})
    if not copy.publish(copy.newest()[0] + 1, {"batches": names, "folded": folded}):
        raise RuntimeError(f"{target} was written to at the same time")
