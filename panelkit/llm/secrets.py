"""Secret scans by dictionary-primed compression novelty (operator 5).

Base patterns find secrets of known shape. The method adds strings in a sensitive context that a compressor can't
predict: what a candidate adds to the compressed size of the text around it is measured in a zstandard frame primed
with the identifiers that stand around candidates all over the corpus.
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: fixed values: the base patterns, in the order of their kinds
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "novel")
LEAST_ASSIGNED = 6

#: words that make what follows them sensitive
SENSITIVE_WORDS = (b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"auth", b"bearer", b"signature", b"private")
#: such words, also those that overlap; a candidate; so many characters and a separator may stand between them
SENSITIVE = re.compile(
    r"(?ai)(?=(pass(?:word|wd|phrase)?|pwd|secret|token|key|credentials?|auth(?:orization)?|bearer|signature|private))"
)
VALUE = re.compile(r"""(?a)(?<=[\s:="'(,])[A-Za-z0-9+/_.=~-]{16,}""")
LEAST_VALUE = 16
REACH = 24
#: characters of text on either side that a candidate is measured against
AROUND = 256
#: share of a candidate's characters that it must add to the compressed text
NOVEL = 0.6
#: the dictionary has the most frequent identifiers, up to so many bytes
DICTIONARY_BYTES = 16_384
IDENTIFIER = "[A-Za-z_][A-Za-z0-9_]{3,}"
LEVEL = 12
#: a longer value is measured in pieces of so many characters, counted from its end
PIECE = 1024


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the secret itself) of the base patterns, leftmost and not overlapping per kind.

    The runs of access and hex are taken whole, so asking for the least length at once finds the same ones.
    """
    small = text.encode("utf-8", "surrogatepass").lower()
    found = []
    if any(w in small for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if b"akia" in small:
        found += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


class Taken:
    """Spans joined where they overlap, so that those at a place are found by bisection."""

    def __init__(self, spans):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted((s[0], s[1]) for s in spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def within(self, low: int, high: int) -> list[tuple[int, int]]:
        """The joined spans that share a character with the text from low to high."""
        first = bisect.bisect_right(self.ends, low)
        return list(zip(self.starts[first:bisect.bisect_left(self.starts, high, first)], self.ends[first:]))

    def meets(self, low: int, high: int) -> bool:
        at = bisect.bisect_right(self.ends, low)
        return at < len(self.starts) and self.starts[at] < high


def candidates(text: str, taken: Taken | list[tuple]) -> list[tuple[int, int]]:
    """Spans in a sensitive context that meet no base span, in order.

    Every value with a sensitive word within reach is one, whatever stands between them, so that no value hides a later
    one. A run of characters gives several values with the same end if it has an equals sign: the whole run, and what
    follows the sign.
    """
    small = text.encode("utf-8", "surrogatepass").lower()
    if not any(w in small for w in SENSITIVE_WORDS):
        return []
    taken = taken if isinstance(taken, Taken) else Taken(taken)
    ends = sorted(m.end(1) for m in SENSITIVE.finditer(text))
    found = []
    for m in VALUE.finditer(text):
        end = m.end()
        starts = [m.start(), *(k + 1 for k in range(m.start(), end - LEAST_VALUE) if text[k] == "=")]
        for start in starts:
            k = bisect.bisect_right(ends, start - 1)
            near = k > 0 and start - 1 - ends[k - 1] <= REACH and "\n" not in text[ends[k - 1]:start - 1]
            if near and not taken.meets(start, end):
                found.append((start, end))
    return found


def context(text: str, start: int, end: int, taken: Taken) -> str:
    """The text around a span, without the span and without other secrets."""
    low, high = max(0, start - AROUND), min(len(text), end + AROUND)
    out, at = [], low
    for a, b in sorted([(start, end), *taken.within(low, high)]):
        if b > at and a < high:
            out.append(text[at:max(a, at)])
            at = max(at, b)
    return "".join(out) + text[at:high]


class Novelty:
    """Marginal compressed bytes of a string after its context, with a primed compressor."""

    def __init__(self, dictionary: bytes):
        import zstandard

        primed = {"dict_data": zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)} if len(dictionary) >= 8 else {}
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False, **primed)

    def added(self, around: str, value: str) -> tuple[int, int]:
        """Bytes that the value adds to the compressed text around it, and its own bytes."""
        before = around.encode("utf-8", "replace")
        own = value.encode("utf-8", "replace")
        return len(self.compressor.compress(before + b"\n" + own)) - len(self.compressor.compress(before + b"\n")), len(own)


def spans_of(text: str, novelty: Novelty) -> list[tuple[int, int, str, int]]:
    base = base_spans(text)
    taken = Taken(base)
    new: list[tuple] = []
    end, pieces = -1, {}

    def added(a: int, b: int) -> tuple[int, int]:
        return novelty.added(context(text, a, b, taken), text[a:b])

    for a, b in candidates(text, taken):
        if b != end:  # values with the same end share all pieces but their first
            end, pieces = b, {}
        # of values with the same end the longest novel one
        if new and new[-1][1] == b:
            continue
        whole = (b - a - 1) // PIECE
        for n in range(len(pieces), whole):
            more = added(b - (n + 1) * PIECE, b - n * PIECE)
            pieces[n] = tuple(x + y for x, y in zip(more, pieces.get(n - 1, (0, 0))))
        total, size = (x + y for x, y in zip(added(a, b - whole * PIECE), pieces[whole - 1] if whole else (0, 0)))
        if total / size >= NOVEL:
            new.append((a, b, "novel", a))
    return sorted(base + new, key=lambda s: (s[0], KINDS.index(s[2])))


def dictionary(docs: DataFrame) -> bytes:
    """The identifiers most frequent around candidates in all documents, the most frequent last, where a compressor
    finds them cheapest. Secrets and candidates themselves are left out, so that copies of one don't make it known.

    Only the first few thousand identifiers reach the driver, DICTIONARY_BYTES at most are kept.
    """

    def contexts(batches):
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                if text:
                    base = base_spans(text)
                    found = candidates(text, Taken(base))
                    both = Taken(base + [(a, b) for a, b in found])
                    longest = [v for n, v in enumerate(found) if n == 0 or found[n - 1][1] != v[1]]
                    out += [context(text, a, b, both) for a, b in longest]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["context"])

    around = docs.select("text").mapInArrow(contexts, "context string")
    names = around.select(F.explode(F.regexp_extract_all("context", F.lit(f"({IDENTIFIER})"), F.lit(1))).alias("name"))
    top = names.groupBy("name").count().orderBy(F.desc("count"), "name").limit(DICTIONARY_BYTES // 5).collect()
    out: list[bytes] = []
    size = 0
    for row in top:
        size += len(row["name"]) + 1
        if size > DICTIONARY_BYTES:
            break
        out.append(row["name"].encode())
    return b" ".join(reversed(out))


def scan(docs: DataFrame, known: bytes | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id and spans, an array of kind, start, end (code points, end exclusive) in
    order of start, then kind. Null and blank texts have none; rows that repeat are scanned each; a null id is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary(docs) if known is None else known)

    def find(batches):
        novelty = Novelty(shared.value)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b} for a, b, k, _ in spans_of(t, novelty)] if t else []
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(kind))], names=["doc_id", "spans"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {key}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def mask(text: str, spans: list[tuple[int, int, str, int]], mark: str) -> str:
    """The text with each secret (of an assignment, its value) replaced; those that overlap are replaced as one."""
    out, at = [], 0
    for start, end in sorted((s[3], s[1]) for s in spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]


def masked_documents(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of docs, with secrets in their texts replaced and n_chars set anew where that changed it."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary(docs))
    names = docs.columns

    def clean(batches):
        novelty = Novelty(shared.value)
        for batch in batches:
            at = names.index("text")
            old = batch.column(at).to_pylist()
            new = [mask(t, spans_of(t, novelty), mark) if t else t for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if "n_chars" in names:
                n = names.index("n_chars")
                sizes = [c if a == b else len(b) for c, a, b in zip(batch.column(n).to_pylist(), old, new)]
                columns[n] = pa.array(sizes, batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)
