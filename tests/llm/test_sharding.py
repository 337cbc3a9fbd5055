import zlib

import pytest
from pyspark.sql import functions as F

from panelkit.llm import sharding


def expected(rows, shards):
    """(id, size, checksum, shard, slot) of (id, text), one after the other."""
    sized = sorted(
        ((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows)
    )
    total, before, slots, out = sum(r[3] for r in sized), 0, [0] * shards, []
    for known, i, crc, size in sized:
        shard = before * shards // total
        out.append((i if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return sorted(out, key=str)


def got(sharded):
    rows = sharded.select("doc_id", sharding.document_size(), sharding.text_crc32(), "shard", "slot").collect()
    return sorted([tuple(r) for r in rows], key=str)


def test_edge_rows(edge):
    sharded = sharding.shard_documents(edge, 5)
    assert got(sharded) == expected([(r.doc_id, r.text) for r in edge.collect()], 5)
    assert [c for c in sharded.columns if c not in ("shard", "slot")] == edge.columns


@pytest.mark.parametrize("probes, part_bytes", [(2, 1 << 30), (4, 700), (1024, 100)])
def test_every_box_is_refined(probes, part_bytes, spark):
    """Keys far apart, negative, missing, and one under which a third of all rows lies, all with the same text."""
    rows = [(i * i * i - 40_000, "x" * (i * 37 % 101)) for i in range(120)]
    rows += [(None, "a text"), (-(2**63), ""), (2**63 - 1, None), (5, "y" * 2000)] + [(77, "copy")] * 60
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(sharding.shard_documents(docs, 16, part_bytes, probes)) == expected(rows, 16)


def test_copies_alone_are_cut_into_equal_shards(spark):
    docs = spark.range(1600).select(F.lit(3).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    counts = sharding.assignment(docs).groupBy("shard").agg(F.count("*"), F.min("slot"), F.max("slot"), F.count_distinct("slot")).collect()
    assert sorted(map(tuple, counts)) == [(s, 100, 0, 99, 100) for s in range(16)]


def test_one_row_larger_than_all_others(spark):
    rows = [(1, "a"), (2, "b" * 10_000), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(sharding.shard_documents(docs)) == expected(rows, 16)


def test_no_rows(empty):
    assert sharding.assignment(empty).collect() == []


def test_plan_is_native_and_moves_rows_once(spark, sf):
    from panelkit.llm.text import table

    plan = sharding.assignment(table(spark, sf, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_written_shards_hold_whole_rows_in_order(edge, spark, tmp_path):
    sharding.write_shards(edge, str(tmp_path / "out"), 3)
    written = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, written.select("doc_id", "text").collect())) == sorted(map(str, edge.select("doc_id", "text").collect()))
    slots = written.groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("s")).collect()
    assert all(r.s == list(range(len(r.s))) for r in slots)
