"""A corpus pipeline of the text operators: one stage after the other, each written and read again.

Every stage takes (spark, docs, sf_dir) with the rows that its predecessor kept and returns a DataFrame; all but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.functions.durable import settle
from panelkit.llm import mixing, ordered, pieces, quality, secrets
from panelkit.llm.text import table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept_documents(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return ordered.one_of_each(docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    return secrets.masked_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken as often as the mix of their sources takes them."""
    return mixing.mixed_texts(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str, model: str | None = None) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and decoded, the text that the ids give back, of every row."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.Codec(spark, model).coded(docs, "doc_id", "lang", "source")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("secrets", masked),
    ("mixing", mixed),
    ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table documents on."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: the robust estimates, sketches and compressed sizes of the stages can't be expressed in SQL
ORACLE_SQL = None
