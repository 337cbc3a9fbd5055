"""Sharding by histogram sort (operator 13): shards of near equal bytes, in key order, after a single exchange.

The bytes below candidate boundaries are counted exactly, over all partitions at once. Candidates stand at equal steps
of a power of two between the least and the largest key of a box; the first box holds all rows. A cell between two
candidates that lies in one part of the output is settled; any other cell becomes a box of the next round, with
candidates of its own, until every cell is settled. What a round counts is one small row per cell. Only then do rows
move: once, to their part, where they are numbered.

Built-in functions alone; cells and boxes are tables, so that neither their number nor the rows' reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.functions.durable import settle

#: candidate boundaries in a box; a power of two
PROBES = 1024
#: bytes that a task of the exchange sorts; a shard is divided into as many parts as it needs
PART_BYTES = 128 << 20
LAW = "bytes"


def _shift(low: Column, high: Column, probes: int) -> Column:
    """The least number of bits to shift by that leaves fewer steps than probes from low to high."""
    steps = lambda s: F.try_subtract(F.call_function("shiftright", high, s), F.call_function("shiftright", low, s))
    # the difference of far keys overflows to null, which is no small number of steps
    return F.array_min(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda s: F.coalesce(steps(s) < probes, F.lit(False))))


def _boxes(cells: DataFrame, n_keys: int, probes: int) -> DataFrame:
    """A box for every cell given: the first key in which its rows differ, with candidates over that key's range."""
    key, low, high = F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long")
    for i in reversed(range(n_keys)):
        differ = F.col(f"_low{i}") < F.col(f"_high{i}")
        key = F.when(differ, F.lit(i)).otherwise(key)
        low, high = F.when(differ, F.col(f"_low{i}")).otherwise(low), F.when(differ, F.col(f"_high{i}")).otherwise(high)
    return (
        cells.withColumns({"_key": key, "_from": low, "_to": high})
        .withColumn("_shift", _shift(F.col("_from"), F.col("_to"), probes))
        .select(F.col("_next").alias("_box"), "_key", "_shift",
                F.call_function("shiftright", F.col("_from"), F.col("_shift")).alias("_first"),
                F.col("_below").alias("_base"), F.col("_rows_below").alias("_base_rows"))
    )


def histogram_sort(
    rows: DataFrame, keys: Sequence[Column], size: Column, shards: int, part_bytes: int = PART_BYTES, probes: int = PROBES
) -> DataFrame:
    """All columns of the rows, `shard` (0 to shards - 1) and `slot` (0 and on within the shard, in key order).

    A row lies in the shard in which its first byte falls when all rows stand one after the other in the order of the
    keys (whole numbers; null is least) and the bytes are cut into `shards` equal lengths. So a shard's size differs
    from the others' by less than its largest row, and one beyond a shard's length leaves following shards empty.
    Sizes are whole numbers from 1 on. Rows equal in all keys are told apart by their place in the input, so that even
    a third of all rows under one key is cut where the bytes demand it. No rows give none.
    Columns `shard` and `slot` of the input are replaced, all others are kept as they are.
    """
    names = [f"_k{i}" for i in range(2 * len(keys) + 1)]
    parted = {}
    for i, k in enumerate(keys):
        parted[f"_k{2 * i}"] = k.isNotNull().cast("long")
        parted[f"_k{2 * i + 1}"] = F.coalesce(k.cast("long"), F.lit(0).cast("long"))
    body = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in ("shard", "slot")]).alias("_body")
    live = settle(
        rows.select(body, size.cast("long").alias("_size"), *[e.alias(n) for n, e in parted.items()])
        .withColumn(names[-1], F.monotonically_increasing_id()).withColumn("_box", F.lit(0).cast("long"))
    )
    spans = [F.min(n).alias(f"_low{i}") for i, n in enumerate(names)] + [F.max(n).alias(f"_high{i}") for i, n in enumerate(names)]
    whole = settle(live.agg(F.coalesce(F.sum("_size"), F.lit(0).cast("long")).alias("_total"), *spans))
    total = whole.first()["_total"]
    parts = shards * max(1, -(-total // (shards * part_bytes)))
    # the product of bytes and parts may exceed a long
    part = lambda at: F.expr(f"cast(({at}) as decimal(25)) * cast({parts} as decimal(12)) div cast({max(1, total)} as decimal(20))")
    zero = F.lit(0).cast("long")
    boxes = settle(_boxes(whole.withColumns({"_next": zero, "_below": zero, "_rows_below": zero}), len(names), probes))
    placed, cells = [], []
    while True:
        own = F.element_at(F.array(*names), F.col("_key") + 1)
        located = live.join(boxes, "_box").withColumn("_cell", F.call_function("shiftright", own, F.col("_shift")) - F.col("_first"))
        earlier = Window.partitionBy("_box").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0).cast("long"))
        counted = settle(
            located.groupBy("_box", "_cell", "_base", "_base_rows")
            .agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_n"), *spans)
            .withColumns({"_below": F.col("_base") + before("_bytes"), "_rows_below": F.col("_base_rows") + before("_n")})
            # the last of a cell's rows begins a byte before the cell's end at the latest
            .withColumns({"_part": part("_below"), "_open": (F.col("_n") > 1) & (part("_below") != part("_below + _bytes - 1"))})
            .withColumn("_next", F.when(F.col("_open"), F.monotonically_increasing_id()))
        )
        found = located.select("_body", "_size", *names, "_box", "_cell").join(
            counted.select("_box", "_cell", "_part", "_rows_below", "_next"), ["_box", "_cell"])
        placed.append(found.filter("_next is null").select("_body", *names, "_part", "_rows_below"))
        cells.append(counted.filter("not _open").select("_part", "_rows_below"))
        boxes = settle(_boxes(counted.filter("_open"), len(names), probes))
        if boxes.isEmpty():
            break
        live = settle(found.filter("_next is not null").select("_body", "_size", *names, F.col("_next").alias("_box")))
    shard = F.expr(f"cast(_part div {parts // shards} as int)").alias("shard")
    starts = reduce(DataFrame.unionByName, cells).groupBy(shard).agg(F.min("_rows_below").alias("_start"))
    inside = Window.partitionBy("_part").orderBy(*names).rowsBetween(Window.unboundedPreceding, 0)
    numbered = reduce(DataFrame.unionByName, placed).select(
        "_body", shard,
        # rows before the part, which are those before its first cell, and the part's own rows
        (F.min("_rows_below").over(inside) + F.row_number().over(inside) - 1).alias("_place"),
    )
    return numbered.join(settle(starts), "shard").select("_body.*", "shard", (F.col("_place") - F.col("_start")).alias("slot"))


def document_size() -> Column:
    """Bytes of the text in UTF-8 (null: none), and one."""
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1


def text_crc32() -> Column:
    return F.crc32(F.coalesce(F.col("text"), F.lit("")))


def shard_documents(docs: DataFrame, shards: int = 16, part_bytes: int = PART_BYTES, probes: int = PROBES) -> DataFrame:
    """The documents with shard and slot, sorted by doc_id, checksum and size of the text."""
    return histogram_sort(docs, [F.col("doc_id"), text_crc32(), document_size()], document_size(), shards, part_bytes, probes)


def write_shards(docs: DataFrame, folder: str, shards: int = 16) -> None:
    """Write the documents as Parquet, a folder shard=<n> for every shard that has rows, files sorted by slot."""
    sorted_rows = shard_documents(docs, shards).sortWithinPartitions("shard", "slot")
    sorted_rows.write.partitionBy("shard").mode("errorifexists").parquet(folder)


def assignment(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null: the law is `bytes`) of every document.

    Null texts have size 1 and checksum 0; null ids come first; repeated rows are rows of their own.
    """
    narrow = docs.select("doc_id", document_size().alias("size"), text_crc32().alias("text_crc32"))
    sharded = histogram_sort(narrow, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], F.col("size"), shards)
    return sharded.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))
