"""Mixing sources to target weights by Sainte-Lague apportionment (operator 6).

Built-in functions only. Texts are read once, for their word counts; everything after works on narrow rows
(identity, source, size). No list of blocks is ever made: quotas are integers per shard, and a document's share of
the taken blocks follows from its offset in the shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.functions.durable import settle
from panelkit.llm.text import BLANKS, n_words, words

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK_WORDS = 16
SHARD_DOCUMENTS = 2048
SEED = 7


def targets(sources: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """Words wanted of each source: shares of all words by weight, none above cap times its own words.

    sources: source, source_size. Weights repeat over the sources in code point order, null last. A source at its cap
    passes its excess on by weight; with the sources sorted by cap per weight, those at their cap are the first ones,
    and one running sum finds where they end. The windows hold one row a source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("_cap_per_weight", "_place")
    before, onward = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1)
    limit = cap * F.col("source_size")
    return (
        sources.withColumn("_place", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("double"))
        .withColumn("_cap_per_weight", limit / F.col("weight"))
        .withColumn("_all", F.sum("source_size").over(everything))
        .withColumn("_level", (F.col("_all") - F.coalesce(F.sum(limit).over(before), F.lit(0))) / F.sum("weight").over(onward))
        .withColumn("_open", F.col("_level") <= F.col("_cap_per_weight"))
        .withColumn("_at", F.max(F.when(F.col("_open"), F.col("_level"))).over(everything))
        .withColumn("target", F.when(F.col("_open"), F.col("_at") * F.col("weight")).otherwise(limit.cast("double")))
        .select("source", "source_size", "target")
    )


def apportion(parties: DataFrame, key: str, votes: str, seats: str, within: str | None = None) -> DataFrame:
    """Add `won`: the integer seats of each party by highest quotients votes / (2 n + 1), ties to the smaller key.

    seats (one value in each group of `within`) may be far too many to list. A divisor that surely gives too few
    seats gives every party its sure seats; only the few quotients between that and a divisor that surely gives too
    many are ranked, about three for each party.
    """
    group = Window.partitionBy(F.lit(1) if within is None else F.col(within))
    ranked = group.orderBy(F.desc("_quotient"), F.col(key).asc_nulls_last())
    share = F.col(votes) * F.col(seats) / F.col("_votes")
    half = F.col("_parties") / 2
    low = F.when(F.col(seats) > half, F.floor(F.col(votes) * (F.col(seats) - half) / F.col("_votes") + 0.5) - 1)
    high = F.floor(share + F.col(votes) * half / F.col("_votes") + 0.5) + 1
    voting = F.col(votes) > 0
    known = (
        parties.withColumn("_votes", F.greatest(F.sum(votes).over(group), F.lit(1e-9)))
        .withColumn("_parties", F.sum(voting.cast("long")).over(group))
        .withColumn("_low", F.when(voting, F.greatest(F.coalesce(low, F.lit(0)), F.lit(0))).otherwise(0).cast("long"))
        .withColumn("_high", F.when(voting, F.greatest(high, F.col("_low") + 1)).otherwise(0).cast("long"))
        .withColumn("_left", F.col(seats) - F.sum("_low").over(group))
    )
    contested = F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1))
    same = [c for c in parties.columns]
    return (
        known.withColumn("_n", F.explode_outer(contested))
        .withColumn("_quotient", F.coalesce(F.col(votes) / (2 * F.col("_n") + 1), F.lit(-1.0)))
        .withColumn("_seat", F.row_number().over(ranked))
        .groupBy(*same, "_low")
        .agg(F.sum(((F.col("_seat") <= F.col("_left")) & F.col("_n").isNotNull()).cast("long")).alias("_more"))
        .withColumn("won", F.col("_low") + F.col("_more"))
        .select(*same, "won")
    )


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _taken(docs: DataFrame, weights, cap: int, block_words: int, shard_documents: int, seed: int) -> DataFrame:
    """The rows of `mix` with what is taken of each: the whole text _passes times, _overlap words from word _first on
    (counted from 0), and its first _wrapped words where the run has come to the shard's beginning again."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = settle(docs.select("doc_id", "source", n_words("text").alias("size")))
    per_source = settle(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows")))
    wanted = targets(per_source.select("source", "source_size"), weights, cap)
    blocks = F.ceil(F.sum("source_size").over(Window.partitionBy(F.lit(1))) / block_words)
    dealt = apportion(wanted.withColumn("_blocks", blocks), "source", "target", "_blocks")
    dealt = settle(
        dealt.alias("d")
        .join(per_source.alias("s"), F.expr("d.source <=> s.source"))
        .select("d.source", "d.source_size", "target", F.col("won").alias("quota"),
                F.ceil(F.col("_rows") / shard_documents).alias("_shards"))
    )
    placed = (
        sized.withColumn("_digest", digest)
        .alias("x")
        .join(dealt.alias("d"), F.expr("x.source <=> d.source"))
        .select("doc_id", "x.source", "size", "source_size", "target", "quota", "_digest",
                F.pmod(_number(F.col("_digest")), F.col("_shards")).alias("_shard"))
    )
    shards = apportion(
        placed.groupBy("source", "quota", "_shard").agg(F.sum("size").alias("_words")),
        "_shard", "_words", "quota", within="source",
    ).withColumnRenamed("won", "_quota")
    start = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("source"), F.lit("")), F.col("_shard").cast("string")))
    runs = settle(
        shards.withColumn("_take", F.least(F.col("_quota") * block_words, cap * F.col("_words")))
        .withColumn("_passes", F.when(F.col("_words") > 0, F.floor(F.col("_take") / F.col("_words"))).otherwise(0))
        .withColumn("_run", F.col("_take") - F.col("_passes") * F.col("_words"))
        .withColumn("_start", F.pmod(_number(start), F.greatest(F.ceil(F.col("_words") / block_words), F.lit(1))) * block_words)
        .select("source", "_shard", "_words", "_passes", "_run", "_start")
    )
    in_shard = Window.partitionBy("source", "_shard").orderBy("_digest", "doc_id", "size")
    offset = F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    end, stop = F.col("_offset") + F.col("size"), F.col("_start") + F.col("_run")
    overlap = F.greatest(F.lit(0), F.least(end, stop) - F.greatest(F.col("_offset"), F.col("_start")))
    wrapped = F.greatest(F.lit(0), F.least(end, stop - F.col("_words")) - F.col("_offset"))
    return (
        placed.withColumn("_offset", offset)
        .alias("p")
        .join(runs.alias("r"), F.expr("p.source <=> r.source and p._shard = r._shard"))
        .select("doc_id", "p.source", "size", "source_size", "target", "_passes",
                F.greatest(F.col("_start") - F.col("_offset"), F.lit(0)).cast("long").alias("_first"),
                overlap.cast("long").alias("_overlap"), wrapped.cast("long").alias("_wrapped"))
    )


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    cap: int = CAP,
    block_words: int = BLOCK_WORDS,
    shard_documents: int = SHARD_DOCUMENTS,
    seed: int = SEED,
) -> DataFrame:
    """Per row of docs (doc_id, text, source): doc_id, source, size, source_size, target, taken.

    The target words of all sources are cut into blocks of block_words words, which highest quotients deal to the
    sources and, within a source, to its shards (about shard_documents documents, by a hash of the id, so that a source
    with a third of all rows is many shards). A shard's documents stand in an order drawn by the seed; its stream of
    words, repeated, gives as many consecutive blocks as the shard's quota, beginning at a block drawn by the seed. So
    documents are taken whole, once or several times, but for the two where a shard's run begins and ends.

    Null and blank texts have size 0 and give 0. A null source is a source of its own; a null id is ordered as the word
    null. Rows that repeat an id count each; between equal rows it is open which one gets a larger share. No rows give
    no rows.
    """
    taken = F.col("_passes") * F.col("size") + F.col("_overlap") + F.col("_wrapped")
    return _taken(docs, weights, cap, block_words, shard_documents, seed).select(
        "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed_texts(
    docs: DataFrame,
    weights=WEIGHTS,
    cap: int = CAP,
    block_words: int = BLOCK_WORDS,
    shard_documents: int = SHARD_DOCUMENTS,
    seed: int = SEED,
) -> DataFrame:
    """The mix as documents: each row whole as often as it is taken whole, and once for each part that is taken, with
    the very words that the mix selects and the blanks between them. Rows of which nothing is taken go, but for texts
    without words, of which the mix takes all there is. n_chars follows the text.

    Rows that share id, source and size are numbered on either side, so that each keeps a share of its own; which one
    gets which share is settled by the rows' hashes.
    """
    plan = _taken(docs, weights, cap, block_words, shard_documents, seed)
    parts = ["_passes", "_first", "_overlap", "_wrapped"]
    same = Window.partitionBy("doc_id", "source", "size").orderBy(*parts)
    plan = plan.withColumn("_number", F.row_number().over(same)).select(
        *[F.col(c).alias(f"_{c}") for c in ("doc_id", "source", "size")], "_number", *parts
    )
    piece = lambda whole, first, count: F.struct(whole.alias("whole"), first.cast("int").alias("first"), count.cast("int").alias("count"))
    no, yes, zero = F.lit(False), F.lit(True), F.lit(0)
    partly = lambda count: (count > 0) & (count < F.col("_size"))
    overlap, wrapped = F.col("_overlap"), F.col("_wrapped")
    copies = F.when(F.col("_size") > 0, F.col("_passes") + (overlap == F.col("_size")).cast("int") + (wrapped == F.col("_size")).cast("int")).otherwise(1)
    pieces = F.concat(
        F.array_repeat(piece(yes, zero, zero), copies.cast("int")),
        F.when(partly(overlap), F.array(piece(no, F.col("_first"), overlap))).otherwise(F.array().cast("array<struct<whole:boolean,first:int,count:int>>")),
        F.when(partly(wrapped), F.array(piece(no, zero, wrapped))).otherwise(F.array().cast("array<struct<whole:boolean,first:int,count:int>>")),
    )
    # each word with the blanks before it
    spaced = F.regexp_extract_all("row.text", F.lit(f"([{BLANKS}]*[^{BLANKS}]+)"), F.lit(1))
    cut = F.ltrim(F.array_join(F.slice(spaced, F.col("_piece.first") + 1, F.col("_piece.count")), ""), F.lit(BLANKS))
    row = F.col("row")
    shorter = row.withField("text", cut)
    if "n_chars" in docs.columns:
        shorter = shorter.withField("n_chars", F.length(cut).cast(docs.schema["n_chars"].dataType))
    rows = docs.select(F.struct(*docs.columns).alias("row"), n_words("text").alias("_n"), F.xxhash64(*docs.columns).alias("_hash"))
    alike = Window.partitionBy("row.doc_id", "row.source", "_n").orderBy("_hash")
    return (
        rows.withColumn("_k", F.row_number().over(alike))
        .join(plan, F.expr("row.doc_id <=> _doc_id and row.source <=> _source and _n = _size and _k = _number"))
        .withColumn("_piece", F.explode(pieces))
        .select(F.when(F.col("_piece.whole"), row).otherwise(shorter).alias("row"))
        .select("row.*")
    )
