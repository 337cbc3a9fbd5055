"""The registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.functions.durable import settle, shared_folder
from panelkit.llm import hidden, lexical, licenses, mixing, oracles, ordered, pieces, quality, rollups, secrets, sharding, structure, vafile, warc
from panelkit.llm.text import table


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives and read back; digest and length of a response are those of the payload read."""
    warc.register(spark)
    archive = f"{shared_folder(spark)}/panelkit-files/warc-{uuid.uuid4().hex}"
    warc.page_records(table(spark, folder, "pages")).write.format("warc").mode("append").save(archive)
    stored = F.col("record_type") == "response"
    return spark.read.format("warc").load(archive).select(
        warc.page_number("record_id").alias("page_id"),
        F.when(stored, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(stored, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", warc.page_number("refers_to").alias("refers_to"),
    )


def op2_hidden(spark: SparkSession, folder: str) -> DataFrame:
    """Every text scored by a hidden Markov model that learns from the documents in training."""
    return hidden.score(table(spark, folder, "documents"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document judged by the base rules and by its robust distance in its language and source."""
    return quality.judge(table(spark, folder, "documents"))


def op4_pieces(spark: SparkSession, folder: str, model: str | None = None) -> DataFrame:
    """Every text encoded and decoded again, as digests of the tokens and of the text."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.Codec(spark, model).coded(table(spark, folder, "documents"), "doc_id").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, as spans."""
    found = secrets.scan(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), count("novel"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to their sources' target weights."""
    return mixing.mix(table(spark, folder, "documents"))


def op7_rollups(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after three batches: every document comes in, those not in English are counted anew by a later
    tokenizer (this batch is committed twice, as after a lost driver), and short ones are withdrawn."""
    docs = table(spark, folder, "documents")
    both = settle(docs.select("doc_id", "source", "lang", *[f("text").alias(v) for v, f in rollups.TOKENIZERS.items()]))

    def of(rows: DataFrame, version: str) -> DataFrame:
        return rows.select("doc_id", "source", "lang", F.lit(version).alias("tokenizer"), F.col(f"`{version}`").alias("n_tokens"))

    other = both.filter(~F.col("lang").eqNullSafe("en"))
    short = both.filter("`blanks-1` < 50")
    store = f"{shared_folder(spark)}/panelkit-files/rollup-{uuid.uuid4().hex}"
    rollups.commit(store, 1, rollups.inserts(of(both, "blanks-1")))
    for _ in range(2):
        rollups.commit(store, 2, rollups.revisions(of(other, "blanks-1"), of(other, "runs-2")))
    now = of(short.filter(F.col("lang").eqNullSafe("en")), "blanks-1").unionByName(
        of(short.filter(~F.col("lang").eqNullSafe("en")), "runs-2"))
    rollups.commit(store, 3, rollups.deletes(now))
    return rollups.totals(spark, store)


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and passages in every document."""
    return licenses.scan(table(spark, folder, "documents"))


def op9_ordered(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the class of its near-duplicates."""
    return ordered.deduplicated(table(spark, folder, "documents"))


def op10_vafile(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best rows for every vector whose id is divisible by 20."""
    return vafile.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_dense(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every item of the benchmark."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_structure(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation's faults after damage, its cheapest edits and the digest of what they leave."""
    rows = table(spark, folder, "conversations")
    return structure.report(structure.damaged(rows), rows)


def op13_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard of sixteen and its place there."""
    return sharding.assignment(table(spark, folder, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_hidden": op2_hidden,
    "op3_quality": op3_quality,
    "op4_pieces": op4_pieces,
    "op5_secrets": op5_secrets,
    "op6_mixing": op6_mixing,
    "op7_rollups": op7_rollups,
    "op8_licenses": op8_licenses,
    "op9_ordered": op9_ordered,
    "op10_vafile": op10_vafile,
    "op11_dense": op11_dense,
    "op12_structure": op12_structure,
    "op13_histogram": op13_histogram,
}
ORACLES = {
    "op1_warc": oracles.ARCHIVE,
    "op6_mixing": oracles.MIXING,
    "op7_rollups": oracles.ROLLUPS,
    "op8_licenses": oracles.licenses(),
    "op10_vafile": oracles.NEAREST,
    "op11_dense": oracles.LEXICAL,
    "op12_structure": oracles.STRUCTURE,
    "op13_histogram": oracles.SHARDS,
}
