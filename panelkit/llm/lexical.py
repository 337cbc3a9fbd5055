"""Ranked lexical search by dense blocked matrix multiplication (operator 11).

Items come in blocks, documents in tiles. A block holds its items' vocabulary and the weight of each term, a tile its own
words and how often each document has them. Where the two meet, the terms that both know are taken in slices: a dense
matrix of weights times a dense matrix of impacts, in float64. All factors are whole numbers, and a slice is short
enough for its partial sums to stay below 2^53, so the product is exact in any order of summation; slices are added as
64-bit integers. Each meeting passes on an item's ten best documents, ties by doc_id, and a window over those rows
leaves the ten best of all.

Texts are read once. The items' words are told to the tasks that read them, and blocks are broadcast, only if their
measured size allows it; else tiles keep all of their words, and blocks and tiles meet by a shuffle.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelkit.functions.durable import settle

#: documents and bytes of a tile, items and terms of a block; a longer text fills a tile or a block of its own
TILE_DOCS, TILE_BYTES = 1024, 2 << 20
BLOCK_ITEMS, BLOCK_TERMS = 256, 65_536
#: terms of a slice at most, and documents multiplied at once
SLICE, COLUMNS = 4096, 512
#: tiles that meet a block in one task where blocks are too large to be broadcast
TOGETHER = 32
#: doc impact: GAIN * tf div (SCALE * tf + 8 * m), so at most GAIN / SCALE
GAIN, SCALE = 1_000_000_000, 1000
EXACT = 2**53

#: bytes of terms, A-Z in lower case; all other ASCII is blank
TERMS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters and digits and of everything beyond ASCII."""
    return text.encode().translate(TERMS).split() if text else []


def _tiles(docs: DataFrame, tile_docs: int, tile_bytes: int, vocabulary=None) -> DataFrame:
    """Tiles of the documents that have a term, as they come: ids (null: not known), n (terms with repeats), words (the
    tile's own, df of each) and entries by document: lengths, word numbers, counts. Of a vocabulary (a broadcast set) only
    its words are kept."""

    def pack(batches):
        ids, n, lengths, words, counts = [], [], [], [], []
        known: dict[bytes, int] = {}
        size = 0

        def tile():
            number = np.concatenate(words)
            body = [np.array(lengths, np.int32), number.astype(np.int32), np.concatenate(counts).astype(np.int32)]
            df = np.bincount(number, minlength=len(known))
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([np.array(n, np.int64).tobytes()]),
                 pa.array([[w.decode() for w in known]], pa.list_(pa.string())), pa.array([df], pa.list_(pa.int64())),
                 *[pa.array([b.tobytes()]) for b in body], pa.array([len(ids)], pa.int64()), pa.array([sum(n)], pa.int64())],
                names=[c.split()[0] for c in TILE.split(", ")])

        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = Counter(terms(text))
                if not found:
                    continue
                ids.append(doc)
                n.append(sum(found.values()))
                if vocabulary is not None:
                    found = {w: found[w] for w in found.keys() & vocabulary.value}
                lengths.append(len(found))
                words.append(np.fromiter((known.setdefault(w, len(known)) for w in found), np.int64, len(found)))
                counts.append(np.fromiter(found.values(), np.int64, len(found)))
                size += len(text)
                if len(ids) >= tile_docs or size >= tile_bytes:
                    yield tile()
                    for part in (ids, n, lengths, words, counts):
                        part.clear()
                    known, size = {}, 0
        if ids:
            yield tile()

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(pack, TILE)


TILE = ("ids array<bigint>, n binary, words array<string>, df array<bigint>, lengths binary, numbers binary, counts binary, "
        "n_docs bigint, n_terms bigint")


def _blocks(items: DataFrame, weights: DataFrame, block_items: int, block_terms: int) -> DataFrame:
    """Blocks of items: their row numbers and ids, the block's vocabulary with weights, and entries by item."""
    weighed = items.select("item", "item_id", F.explode("terms").alias("term")).join(weights, "term")
    listed = weighed.groupBy("item", "item_id").agg(F.collect_list(F.struct("term", "w")).alias("terms"))

    def pack(batches):
        rows, ids, entries = [], [], []
        known: dict[str, int] = {}
        weight: list[int] = []

        def block():
            return pa.RecordBatch.from_arrays(
                [pa.array([rows], pa.list_(pa.int64())), pa.array([ids], pa.list_(pa.int64())), pa.array([list(known)], pa.list_(pa.string())),
                 pa.array([np.array(weight, np.int64).tobytes()]), pa.array([np.array([len(e) for e in entries], np.int64).tobytes()]),
                 pa.array([np.concatenate(entries).astype(np.int32).tobytes()])], names=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            for item, own, listed_terms in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (len(rows) >= block_items or len(known) + len(listed_terms) > block_terms):
                    yield block()
                    rows, ids, entries, known, weight = [], [], [], {}, []
                numbers = []
                for t in listed_terms:
                    at = known.setdefault(t["term"], len(known))
                    if at == len(weight):
                        weight.append(t["w"])
                    numbers.append(at)
                rows.append(item)
                ids.append(own)
                entries.append(np.array(numbers, np.int64))
        if rows:
            yield block()

    return listed.mapInArrow(pack, BLOCK)


BLOCK = "rows array<bigint>, item_ids array<bigint>, vocabulary array<string>, weights binary, entries binary, members binary"


def _meet(block, tile, total_docs: int, total_terms: int, k: int, slice_: int, columns: int):
    """(item row, item id, doc id, score) of the k best documents of a tile for every item of a block."""
    weight = np.frombuffer(block["weights"], np.int64)
    place = {w: i for i, w in enumerate(block["vocabulary"])}
    shared = [(place[w], j) for j, w in enumerate(tile["words"]) if w in place]
    if not shared:
        return
    ours, theirs = (np.array(x) for x in zip(*shared))
    # compact: only the terms that both sides know, numbered from 0
    of_block, of_tile = np.full(len(weight), -1), np.full(len(tile["words"]), -1)
    of_block[ours] = of_tile[theirs] = np.arange(len(shared))
    items = np.repeat(np.arange(len(block["rows"])), np.frombuffer(block["entries"], np.int64))
    member = of_block[np.frombuffer(block["members"], np.int32)]
    items, member = items[member >= 0], member[member >= 0]
    n = np.frombuffer(tile["n"], np.int64)
    lengths = np.frombuffer(tile["lengths"], np.int32)
    number = of_tile[np.frombuffer(tile["numbers"], np.int32)]
    doc = np.repeat(np.arange(len(n)), lengths)[number >= 0]
    tf, number = np.frombuffer(tile["counts"], np.int32)[number >= 0].astype(np.int64), number[number >= 0]
    m = 100 - 90 + (90 * n * total_docs) // total_terms
    impact = (GAIN * tf) // (SCALE * tf + 8 * m[doc])
    largest = max(1, int(weight[ours].max(initial=0))) * (GAIN // SCALE)
    width = max(1, min(slice_, (EXACT - 1) // largest))
    doc_ids = tile["ids"]
    order = np.array(sorted(range(len(n)), key=lambda i: (doc_ids[i] is None, doc_ids[i])))
    scores = np.zeros((len(block["rows"]), len(n)), np.int64)
    for start in range(0, len(shared), width):
        part = (member >= start) & (member < start + width)
        left = np.zeros((len(block["rows"]), min(width, len(shared) - start)))
        left[items[part], member[part] - start] = weight[ours][member[part]]
        mine = (number >= start) & (number < start + width)
        for at in range(0, len(n), columns):
            a, b = np.searchsorted(doc, (at, at + columns))
            own = np.flatnonzero(mine[a:b]) + a
            right = np.zeros((left.shape[1], min(columns, len(n) - at)))
            right[number[own] - start, doc[own] - at] = impact[own]
            scores[:, at:at + columns] += (left @ right).astype(np.int64)
    scores = scores[:, order]
    for row in range(len(scores)):
        line = scores[row]
        # everything from the k-th score on, ties included, then by score and place in the order of the ids
        least = max(1, int(np.partition(line, -k)[-k])) if len(line) > k else 1
        found = np.flatnonzero(line >= least)
        for i in found[np.argsort(-line[found], kind="stable")][:k]:
            yield block["rows"][row], block["item_ids"][row], doc_ids[order[i]], int(line[i])


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, tile_docs: int = TILE_DOCS, tile_bytes: int = TILE_BYTES,
    block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS, slice_: int = SLICE, columns: int = COLUMNS,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents (doc_id, text) for each item (item_id, text).

    Rows that repeat an id are documents, or items, of their own; null ids come last among equal scores. Null texts and
    texts without a term take no part, nor do scores of 0. No documents or no items give no rows. Other columns are
    left aside. `broadcast_bytes` is the largest measured size of words and of blocks to be broadcast (default: the
    session's threshold).
    """
    spark = docs.sparkSession
    if broadcast_bytes is None:
        broadcast_bytes = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = F.filter(F.split(lower, "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"), lambda t: t != "")
    numbered = settle(items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.array_distinct(split).alias("terms")))
    wanted = settle(numbered.select(F.explode("terms").alias("term")).distinct())
    vocabulary = None
    if wanted.agg(F.coalesce(F.sum(F.octet_length("term") + 8), F.lit(0))).first()[0] <= broadcast_bytes:
        vocabulary = spark.sparkContext.broadcast(frozenset(r.term.encode() for r in wanted.collect()))
    tiles = settle(_tiles(docs, tile_docs, tile_bytes, vocabulary).withColumn("tile", F.monotonically_increasing_id()))
    total = tiles.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms"), F.count("*").alias("tiles")).first()
    result = "item long, item_id long, doc_id long, score long"
    # a tile counts its documents per word, so that the most frequent word is one row per tile
    counted = tiles.select(F.explode(F.arrays_zip("words", "df")).alias("e")).groupBy(F.col("e.words").alias("term")).agg(F.sum("e.df").alias("df"))
    ratio = F.lit(2 * (total["docs"] or 0) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weights = settle(counted.join(wanted, "term").select("term", F.floor(F.log(ratio) * 1000).cast("long").alias("w")))
    blocks = settle(_blocks(numbered, weights, block_items, block_terms))
    size = blocks.agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length("weights") + F.octet_length("entries") + F.octet_length("members")
              + F.aggregate("vocabulary", F.lit(0), lambda s, w: s + F.octet_length(w) + 16)).alias("bytes"),
    ).first()
    if not size["n"] or not total["docs"]:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    # every tile meets every block once, by the block's number
    blocks = settle(blocks.select("*", (F.row_number().over(Window.orderBy(F.col("rows")[0])) - 1).alias("_b")))
    pairs = tiles.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(size["n"] - 1))))
    if size["bytes"] <= broadcast_bytes:
        pairs = pairs.join(F.broadcast(blocks), "_b")
    else:
        # groups of some tiles, so that no block is a hot key of the shuffle
        groups = -(-total["tiles"] // TOGETHER)
        pairs = pairs.withColumn("_t", F.pmod(F.xxhash64("tile"), F.lit(groups))).join(
            blocks.withColumn("_t", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))), ["_b", "_t"])
    names = [c.split()[0] for c in BLOCK.split(", ") + TILE.split(", ")[:-2]]
    n_block = len(BLOCK.split(", "))

    def meet(batches):
        for batch in batches:
            for at in range(len(batch)):  # one meeting at a time in memory
                row = [c[at].as_py() for c in batch.columns]
                block, tile = dict(zip(names[:n_block], row)), dict(zip(names[n_block:], row[n_block:]))
                found = list(_meet(block, tile, total["docs"], total["terms"], k, slice_, columns))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*found)], names=["item", "item_id", "doc_id", "score"])

    best = pairs.select(*names).mapInArrow(meet, result)
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
    )
