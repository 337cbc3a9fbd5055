"""Exact top-k search with a vector-approximation file (operator 10).

Every vector is kept as one small cell number per dimension. A scan over the cells bounds each inner product from both
sides; only what may still be among the k best is read exactly, in the order of the bounds, until the k-th result is
certain. Queries and vectors meet in blocks: a cell of the grid (query block, vector block) is one row. A task that scans
many vector blocks keeps the k best lower bounds of its queries, and passes on only what they leave open at last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.functions.durable import settle

SCALE = 64
#: cells per dimension, chosen to hold about equally many vectors; a cell number is one byte
CELLS = 64
VECTOR_BLOCK, QUERY_BLOCK, QUERY_SLICE, VECTOR_SLICE = 16_384, 1024, 256, 4096
#: blocks that share a key of the join: vector blocks are copied for every group of query blocks, and the other way round
QUERY_GROUP, VECTOR_GROUP = 8, 64
#: candidates that a task holds back, until its queries' bounds have risen; those that are still open then go on
HELD = 2**19
#: scaled components are whole numbers up to this size, larger ones are cut to it; scores are cut to the range of a long
LARGEST = 10**18
#: scores of vectors whose lengths multiply to less fit a long at every step; others are added up as decimals
FITS = float(2**62)


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and q, the vector in whole numbers, floor(scale * x); without vectors that are null or have null or
    non-finite components."""
    x = F.col("embedding").cast("array<double>")
    fine = x.isNotNull() & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    most = F.lit(float(LARGEST))
    floors = F.transform(x, lambda v: F.floor(F.greatest(-most, F.least(most, v * scale))))
    return vectors.filter(fine).select("vec_id", floors.alias("q"))


def _grid(vectors: DataFrame, width: int) -> list[tuple[int, int, list[int]]]:
    """Per dimension the least value, the largest one, and where new cells begin. A sketch of the distribution chooses
    the cells; wherever they begin, the bounds hold."""
    parts = [i / CELLS for i in range(1, CELLS)]
    rows = (
        vectors.select(F.posexplode("q").alias("d", "v")).groupBy("d")
        .agg(F.min("v").alias("low"), F.max("v").alias("high"), F.percentile_approx("v", parts, 1000).alias("inner"))
        .collect()
    )
    found = {r["d"]: (r["low"], r["high"], sorted({t for t in r["inner"] if t > r["low"]})) for r in rows}
    return [found[d] for d in range(width)]


def _packed(rows: DataFrame, size: int, width: int, convert) -> DataFrame:
    """Blocks of up to `size` rows, from the rows of a task as they come: first (a row number), rows, body."""

    def pack(batches):
        ids, parts, n = [], [], 0

        def block():
            keys = np.concatenate(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([int(keys[0])], pa.int64()), pa.array([keys.tobytes()], pa.binary()),
                 pa.array([convert(np.concatenate(parts)).tobytes()], pa.binary())], names=["first", "rows", "body"])

        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            keys = batch.column(0).to_numpy()
            for at in range(0, len(keys), size):
                if n + len(keys[at:at + size]) > size and n:
                    yield block()
                    ids, parts, n = [], [], 0
                ids.append(keys[at:at + size])
                parts.append(values[at:at + size])
                n += len(ids[-1])
        if n:
            yield block()

    return rows.select("row", "q").mapInArrow(pack, "first long, rows binary, body binary")


def _raised(best: np.ndarray, i: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The k best lower bounds of each query (best: one row a query) when lower[n] is one more of query i[n]."""
    n, k = best.shape
    query, value = np.concatenate([np.repeat(np.arange(n), k), i]), np.concatenate([best.ravel(), lower])
    order = np.lexsort((-value, query))
    return value[order[np.searchsorted(query[order], np.arange(n))[:, None] + np.arange(k)]]


def _bounded(grid, width: int, k: int):
    """The scan: candidates of each pair of blocks, with bounds of their scores."""
    inner = [np.array(g[2], dtype=np.int64) for g in grid]
    low, high = np.zeros((width, CELLS)), np.zeros((width, CELLS))
    for d, (least, most, starts) in enumerate(grid):
        edges = [least, *starts]
        low[d, :len(edges)], high[d, :len(edges)] = edges, [*[s - 1 for s in starts], most]
    middle, reach, largest = (low + high) / 2, (high - low) / 2, np.maximum(np.abs(low), np.abs(high)).max(axis=1)

    def cells(values: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(inner[d], values[:, d], side="right") for d in range(width)], axis=1).astype(np.uint8)

    def meet(queries, q, rows, code, best):
        """Candidates of a query block in a vector block; best, the queries' k best lower bounds so far, is kept up to date."""
        slack, dims = 1 + 1e-9 * np.abs(q) @ largest, np.arange(width)
        for start in range(0, len(rows), VECTOR_SLICE):
            some, own = rows[start:start + VECTOR_SLICE], code[start:start + VECTOR_SLICE]
            centre, around = middle[dims, own].T, reach[dims, own].T
            for at in range(0, len(queries), QUERY_SLICE):
                part = slice(at, at + QUERY_SLICE)
                score, apart = q[part] @ centre, np.abs(q[part]) @ around
                apart += slack[part, None]
                upper = score + apart
                lower = np.subtract(score, apart, out=score)
                itself = queries[part, None] == some[None, :]
                upper[itself] = lower[itself] = -np.inf
                kth = least = best[part].min(axis=1)
                if len(some) > k and np.isneginf(kth).any():
                    least = np.maximum(kth, np.partition(lower, -k, axis=1)[:, -k])
                i, j = np.nonzero((upper >= least[:, None]) & ~itself)
                if not len(i):
                    continue
                found = lower[i, j]
                higher = found > kth[i]
                if higher.any():
                    best[part] = _raised(best[part], i[higher], found[higher])
                yield at + i, some[j], upper[i, j], found

    def still(held):
        """Keeps what the bounds, as they are by now, leave open; how much that is."""
        for at, (queries, best, i, *rest) in enumerate(held):
            open_ = rest[1] >= best.min(axis=1)[i]
            held[at] = queries, best, i[open_], *(x[open_] for x in rest)
        return sum(len(x[2]) for x in held)

    def told(held):
        while held:
            parts, n = [], 0
            while held and n < VECTOR_BLOCK:
                queries, _, i, *rest = held.pop()
                parts.append((queries[i], *rest))
                n += len(i)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=["query", "row", "upper", "lower"])

    def scan(batches):
        group, kept, held, n = None, {}, [], 0
        for batch in batches:
            for at in range(len(batch)):  # one meeting at a time in memory
                now, first = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                queries, q, rows, code = (np.frombuffer(c[at].as_buffer(), t) for c, t in zip(batch.columns[2:], (np.int64, np.int64, np.int64, np.uint8)))
                if now != group:
                    still(held)
                    yield from told(held)
                    group, kept, n = now, {}, 0
                if first not in kept:
                    kept[first] = queries.copy(), np.full((len(queries), k), -np.inf)
                own, best = kept[first]
                for found in meet(queries, q.reshape(-1, width).astype(np.float64), rows, code.reshape(-1, width), best):
                    held.append((own, best, *found))
                    n += len(found[0])
                    if n > HELD and (n := still(held)) > HELD // 2:
                        yield from told(held)
                        n = 0
        still(held)
        yield from told(held)

    return cells, scan


def _score() -> Column:
    """The exact inner product, as a decimal."""
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    wide = lambda x: x.cast("decimal(19,0)")
    whole = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
    far = F.aggregate(
        F.zip_with("a", "b", lambda x, y: wide(x) * wide(y)), F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x).cast("decimal(38,0)"))
    return F.when(length("a") * length("b") < FITS, whole.cast("decimal(38,0)")).otherwise(far)


def search(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = SCALE) -> DataFrame:
    """The k rows of highest inner product with each query row, but for itself: query_id, rank, vec_id, score.

    Vectors are rows of vec_id and embedding; ties go to the smaller vec_id, and fewer rows than k give all. Shorter
    vectors count as filled up with zeros. Rows that repeat an id are rows of their own, as queries and as results.
    No usable vector or query gives no rows. Null and non-finite vectors take no part (see scaled); a row without an id is
    no query, but may be found, after others of the same score. Components and scores beyond LARGEST and a long are cut.
    """
    spark = vectors.sparkSession
    usable = scaled(vectors, scale)
    width = usable.agg(F.max(F.size("q"))).first()[0]
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not width:
        return none
    filled = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.get("q", i), F.lit(0)).cast("long"))
    exact = settle(usable.select(F.monotonically_increasing_id().alias("row"), "vec_id", filled.alias("q")))
    cells, scan = _bounded(_grid(exact, width), width, k)
    file = settle(_packed(exact, VECTOR_BLOCK, width, cells))
    queries = settle(_packed(exact.filter(is_query), QUERY_BLOCK, width, lambda q: q))
    n_file, n_queries = file.count(), queries.count()
    if not n_queries:
        return none
    across = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    group = lambda n: F.pmod(F.xxhash64("first"), F.lit(n)).cast("int")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    q_groups = max(min(n_queries, tasks), -(-n_queries // QUERY_GROUP))
    v_groups = max(min(n_file, -(-tasks // q_groups)), -(-n_file // VECTOR_GROUP))
    # merged, as the optimizer knows the size of the blocks, but not that of their copies, and would broadcast them
    meetings = (
        file.select("rows", "body", group(v_groups).alias("_v"), across(q_groups).alias("_q")).alias("y")
        .join(queries.select("first", "rows", "body", group(q_groups).alias("_q"), across(v_groups).alias("_v")).alias("x").hint("merge"), ["_q", "_v"])
        .select("_q", "x.first", "x.rows", F.col("x.body").alias("b1"), F.col("y.rows").alias("r2"), F.col("y.body").alias("b2"))
    )
    bounds = settle(meetings.mapInArrow(scan, "query long, row long, upper double, lower double"))
    best = Window.partitionBy("query").orderBy(F.desc("lower"))
    floor = bounds.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k).groupBy("query").agg(
        F.when(F.count("*") == k, F.min("lower")).otherwise(float("-inf")).alias("floor")
    )
    in_order = Window.partitionBy("query").orderBy(F.desc("upper"), "row")
    open_ = settle(
        bounds.join(floor, "query").filter("upper >= floor").select("query", "row", "upper", F.row_number().over(in_order).alias("place"))
    )
    read, done, size = None, 0, 2 * k
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    while True:
        turn = open_.filter((F.col("place") > done) & (F.col("place") <= done + size))
        if read is not None:
            certain = read.groupBy("query").agg(F.when(F.count("*") == k, F.min("score").cast("double")).alias("kth"))
            waiting = settle(open_.filter(F.col("place") > done).join(certain, "query", "left").filter("kth is null or upper >= kth"))
            if waiting.isEmpty():
                break
            turn = waiting.filter(F.col("place") <= done + size)
        # merged as well: vectors that are much alike are small files, but not small in memory
        scored = (
            turn.select("query", "row")
            .join(exact.filter(is_query).select(F.col("row").alias("query"), F.col("q").alias("a")).hint("merge"), "query")
            .join(exact.select("row", "vec_id", F.col("q").alias("b")).hint("merge"), "row")
            .select("query", "row", "vec_id", _score().alias("score"))
        )
        both = scored if read is None else scored.unionByName(read.drop("rank"))
        read = settle(both.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k))
        done, size = done + size, 2 * size
    ids = exact.filter(is_query).select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return read.join(ids.hint("merge"), "query").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id",
        F.greatest(F.lit(-(2**63)).cast("decimal(38,0)"), F.least(F.lit(2**63 - 1).cast("decimal(38,0)"), F.col("score"))).cast("long").alias("score"))
