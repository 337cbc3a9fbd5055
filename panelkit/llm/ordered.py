"""Near-duplicates by order min-hashing (operator 9).

A text's five-word shingles are labelled with their occurrence. Each sketch draws the few smallest of them by a hash
and keeps their order in the text, so two texts share it if they share the shingles and their order: edits and moves
both break it. Texts that share a sketch are candidates; an alignment in the band that the similarity leaves open
decides. Texts of few shingles, of which sketches may miss a pair, meet by the first of their shingles in an order common
to all texts instead, where two similar ones always meet. Exact copies are one text from the beginning, and within a bucket only links between texts that are not yet
connected are looked for, so a group of many copies costs about as many alignments as it has members.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelkit.functions.durable import settle

#: words in a shingle, and the share of aligned shingles of two near-duplicates
SHINGLE, SIMILARITY = 5, 0.8
#: shingles in a sketch and sketches of a text: two texts of the least similarity share none with odds of 1 to 38,000
DRAWN, SKETCHES = 4, 20
SEED = 5
#: texts of up to so many shingles meet by their first ones alone; longer ones that may be similar to such a text do also
SHORT = 24
#: members and words of a block of a bucket; a larger bucket is compared block by block
BLOCK, BLOCK_WORDS = 1024, 1_000_000
#: cells with fewer members are compared without bitmaps
FEW = 12

MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
STEP = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes | None) -> np.ndarray:
    """A checksum of each word (run of anything but ASCII blanks, A-Z in lower case)."""
    words = text.lower().split() if text else []
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX1
    x = (x ^ (x >> np.uint64(33))) * MIX2
    return x ^ (x >> np.uint64(33))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the labelled shingles in the order of the text; a shorter text is one shingle."""
    n = len(words) - SHINGLE + 1
    wide = words.astype(np.uint64) + np.uint64(1)
    if n < 1:
        wide = np.concatenate([wide, np.zeros(SHINGLE - len(words), np.uint64)])
        n = 1
    found = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        found = _mixed(found * STEP + wide[k:k + n])
    order = np.argsort(found, kind="stable")
    run = found[order]
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    if len(first) < n:
        occurrence = np.empty(n, np.uint64)
        occurrence[order] = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        found = np.where(occurrence > 0, _mixed(found + occurrence * STEP), found)
    return found


_ODD = np.random.RandomState(SEED).randint(0, 2**62, SKETCHES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = np.random.RandomState(SEED + 1).randint(0, 2**62, SKETCHES).astype(np.uint64)


def sketches(labelled: np.ndarray) -> np.ndarray:
    """One number for each sketch: its drawn shingles in the order of the text."""
    drawn = min(DRAWN, len(labelled))
    if len(labelled) <= 20_000:
        hashed = (labelled[None, :] ^ _SHIFT[:, None]) * _ODD[:, None]
        places = np.argpartition(hashed, drawn - 1, axis=1)[:, :drawn] if drawn < len(labelled) else np.tile(np.arange(drawn), (SKETCHES, 1))
    else:
        places = np.stack([np.argpartition((labelled ^ s) * o, drawn - 1)[:drawn] for s, o in zip(_SHIFT, _ODD)])
    chosen = labelled[np.sort(places, axis=1)]
    out = _mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * STEP)
    for k in range(drawn):
        out = _mixed(out + chosen[:, k])
    return out.view(np.int64)


def first_ones(labelled: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The least shingles by hash, as many as a text may lack of a similar one, and one more: two similar texts have one of
    these in common, since the least shingle that both have is among them in either text."""
    most = len(labelled) - math.ceil(similarity * len(labelled) - 1e-9) + 1
    hashed = np.sort(_mixed(labelled ^ _SHIFT[0]))[:most]
    return _mixed(hashed + STEP).view(np.int64)


def meetings(labelled: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Numbers of the buckets of a text."""
    if len(labelled) <= SHORT:
        return first_ones(labelled, similarity)
    if similarity * len(labelled) <= SHORT:
        return np.concatenate([sketches(labelled), first_ones(labelled, similarity)])
    return sketches(labelled)


class Text:
    """A text in a bucket: its labelled shingles, sorted, with their places."""

    def __init__(self, row: int, words: np.ndarray):
        self.row = row
        labelled = shingles(words)
        self.places = np.argsort(labelled, kind="stable")
        self.sorted = labelled[self.places]

    def __len__(self):
        return len(self.sorted)


def most_aligned(a: Text, b: Text, similarity: float = SIMILARITY) -> int:
    """Length of the longest common subsequence of the labelled shingles within the band: in an alignment as good as
    `similarity`, a shingle can't be further from its partner's place than the shingles that have none. As labels make
    shingles unique, it is the longest rising run of partners' places."""
    at = np.searchsorted(b.sorted, a.sorted)
    at[at == len(b)] = 0
    met = b.sorted[at] == a.sorted
    here, there = a.places[met], b.places[at[met]]
    band = int((1 - similarity) * (len(a) + len(b)) / (1 + similarity)) + 1
    inside = np.abs(here - there) <= band
    order = np.argsort(here[inside])
    partners = there[inside][order]
    if len(partners) < 2 or (partners[1:] > partners[:-1]).all():
        return len(partners)
    ends: list[int] = []
    for p in partners.tolist():
        at = bisect_left(ends, p)
        ends[at:at + 1] = [p]
    return len(ends)


def similar(a: Text, b: Text, similarity: float = SIMILARITY) -> bool:
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    common = most_aligned(a, b, similarity)
    return common >= similarity * (len(a) + len(b) - common) - 1e-9


def _open_pairs(texts: list[Text], left: int, similarity: float) -> np.ndarray:
    """Which pairs bitmaps of the shingles leave open, as a matrix. A bit that only one of two texts has is a shingle
    that the other lacks, so shared bits bound the shared shingles from above. left: texts of the first of two blocks,
    which are compared with the others only; 0 for one block."""
    sizes = np.array([len(t) for t in texts], dtype=np.float32)
    bits = min(max(1 << int(8 * np.median(sizes)).bit_length(), 256), 1 << 14)
    has = np.zeros((len(texts), bits), dtype=np.float32)
    for i, t in enumerate(texts):
        has[i, (t.sorted & np.uint64(bits - 1)).astype(np.int64)] = 1
    spare = sizes - has.sum(axis=1)  # shingles that share a bit with another one of their text
    open_ = np.zeros((len(texts), len(texts)), dtype=bool)
    for at in range(0, len(texts), 128):
        rows = slice(at, min(at + 128, len(texts)))
        shared = has[rows] @ has.T
        shared += np.minimum(spare[rows, None], spare[None, :])
        both = sizes[rows, None] + sizes[None, :]
        open_[rows] = (shared >= similarity * (both - shared) - 1e-3) & (
            np.minimum(sizes[rows, None], sizes[None, :]) * (1 + similarity) >= similarity * both - 1e-3)
    if left:
        open_[:left, :left] = open_[left:, left:] = False
    else:
        np.fill_diagonal(open_, False)
    return open_


def links(texts: list[Text], left: int = 0, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Rows of similar texts that connect all texts that any similar pairs connect: at most one less than texts.

    Texts with many open pairs come first: the middle of a group connects most of it at once.
    """
    n = len(texts)
    if n <= FEW:
        open_ = np.ones((n, n), dtype=bool)
        if left:
            open_[:left, :left] = open_[left:, left:] = False
    else:
        open_ = _open_pairs(texts, left, similarity)
    group, found = np.arange(n), []
    for i in np.argsort(-open_.sum(axis=1), kind="stable"):
        for j in np.flatnonzero(open_[i] & (group != group[i])):
            if group[j] != group[i] and similar(texts[i], texts[j], similarity):
                group[group == group[j]] = group[i]
                found.append((texts[i].row, texts[j].row))
        open_[:, i] = False  # both ways are done
    return found


def _sketched(docs: DataFrame, similarity: float) -> DataFrame:
    """row, digest, words, sketches of the texts of docs, each text once in a task."""

    def sketch(batches):
        seen: set[bytes] = set()
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, len(b), 1000)):
            rows, digests, words, found = [], [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                digest = hashlib.md5(text or b"").digest()
                if digest in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(digest)
                own = tokens(text)
                rows.append(row)
                digests.append(digest)
                words.append(own.tobytes())
                found.append(meetings(shingles(own), similarity))
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            ends = np.cumsum([0, *map(len, found)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(digests, pa.binary()), pa.array(words, pa.binary()), lists],
                names=["row", "digest", "words", "sketches"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "text")
    return settle(rows.mapInArrow(sketch, "row long, digest binary, words binary, sketches array<long>"))


def _digest():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def _compared(cells: DataFrame, similarity: float) -> DataFrame:
    """Links of the cells; the rows of a cell stand together, and a cell has at most two blocks."""

    def compare(batches):
        current, members = None, []

        def finish():
            members.sort(key=lambda m: (m[0], m[1]))
            texts = [Text(row, np.frombuffer(words, np.uint32)) for _, row, words in members]
            blocks = {m[0] for m in members}
            left = sum(m[0] == members[0][0] for m in members) if current[1] != current[2] else 0
            return links(texts, left, similarity) if len(blocks) == 1 + (current[1] != current[2]) else []

        found: list[tuple[int, int]] = []

        def out():
            a = np.array(found, dtype=np.int64).reshape(-1, 2)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

        for batch in batches:
            for bucket, low, high, block, row, words in zip(*(c.to_pylist() for c in batch.columns)):
                if (bucket, low, high) != current:
                    if members:
                        found.extend(finish())
                    current, members = (bucket, low, high), []
                members.append((block, row, words))
            yield out()
        if members:
            found.extend(finish())
        yield out()

    together = cells.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return together.select("bucket", "low", "high", "block", "row", "words").mapInArrow(compare, "a long, b long")


def connected(links_: DataFrame) -> DataFrame:
    """node and root (the smallest node it is connected with) of all nodes of the links (a, b), by alternating stars.

    A large star hangs the larger neighbours of a node onto its smallest one, a small star the smaller ones; rounds
    grow with the logarithm of the longest path. A hub with very many links is a hot key of a join with a table of one
    row a node, which adaptive execution splits. Each round is written; two equal rounds end it.
    """
    edges = settle(links_.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u < v").distinct())
    mark = lambda e: e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum((F.xxhash64("v", "u") % 1_000_003))).first()
    before = mark(edges)
    while True:
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        edges = settle(both.join(least, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct())
        least = edges.groupBy("v").agg(F.min("u").alias("m"))
        hung = edges.join(least, "v").filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        edges = settle(hung.unionByName(least.select("v", F.col("m").alias("u"))).distinct())
        after = mark(edges)
        if after == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        before = after


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Per distinct text of docs: digest (MD5), root (its class), least (its smallest doc_id), class_id (the smallest
    doc_id of the class)."""
    sketched = _sketched(docs, similarity)
    first = settle(sketched.groupBy("digest").agg(F.min("row").alias("row")))
    again = settle(sketched.select("row", "digest").join(first.withColumnRenamed("row", "_row"), "digest").filter("row <> _row").select("row"))
    entries = sketched.select(
        "row", F.octet_length("words").alias("size"), F.explode("sketches").alias("bucket")
    ).join(again, "row", "left_anti")
    sizes = entries.groupBy("bucket").agg(
        F.count("*").alias("n"), (F.sum("size") / 4).alias("n_words"), F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y")
    ).filter("n > 1")
    # sketches that bring the same texts together are one bucket
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("n_words") / BLOCK_WORDS)).cast("int").alias("blocks")
    buckets = settle(sizes.groupBy("n", "n_words", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", blocks))
    blocks = F.col("blocks")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    members = (
        entries.join(buckets, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("row"), blocks).cast("int"))
        .withColumn("_other", other)
        .select("bucket", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"), "block", "row")
    )
    found = settle(_compared(members.join(sketched.select("row", "words"), "row"), similarity).distinct())
    roots = connected(found)
    smallest = docs.groupBy(_digest().alias("digest")).agg(F.min("doc_id").alias("least"))
    texts = (
        smallest.join(first, "digest")
        .join(roots.withColumnRenamed("node", "row"), "row", "left")
        .select("digest", "least", F.coalesce("root", "row").alias("root"))
    )
    texts = settle(texts)
    ids = texts.groupBy("root").agg(F.min("least").alias("class_id"))
    return texts.join(ids, "root").select("digest", "root", "least", "class_id")


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id and class_id, the smallest id among the documents it is linked with.

    Texts are linked if they are equal, or if a sketch brings them together and at least `similarity` of the labelled
    shingles of both are aligned; classes are what links connect. Null texts count as empty ones, which are copies of
    each other; texts of fewer than five words are one shingle. Rows that repeat are in one class. The id of a class
    without any id is null. No rows give no rows.
    """
    keyed = docs.select("doc_id", _digest().alias("digest"))
    return keyed.join(classes(docs, similarity), "digest").select("doc_id", "class_id")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One whole row of docs of each class: that of the smallest id, any one of those that share it."""
    chosen = (
        classes(docs, similarity).filter("least <=> class_id").groupBy("root")
        .agg(F.min("digest").alias("_digest"), F.first("class_id").alias("_id"))
    )
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", _digest().alias("_d"))
    kept = rows.join(chosen, F.expr("_d = _digest and doc_id <=> _id"))
    return kept.groupBy("_digest").agg(F.first("row").alias("row")).select("row.*")
