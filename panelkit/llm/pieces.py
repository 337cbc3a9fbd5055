"""SentencePiece encoding and decoding of merge-type (BPE) models (operator 4).

A text's tokens are found by backtracking: at each place the longest token is tried first, then its shorter prefixes;
a token may follow another one only if merging their joined characters anew gives just the two; places from which
nothing fits are marked as failed. A chain of tokens whose neighbours are all compatible is what merging the whole
text gives, so this is exact. Work is done in Arrow batches inside Spark's tasks; the vocabulary (a file of fixed
size) is read by the driver and broadcast.
"""

from __future__ import annotations

import array
import codecs
import hashlib
import re
import struct
import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: fixed values: the format's piece types and its stand-in for a blank
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BLANK = "▁"
#: words and token pairs that a worker remembers. Words that were not met while as many others were are forgotten, pairs
#: start anew when there are too many
WORDS, PAIRS = 500_000, 400_000
LONGEST_REMEMBERED = 48
#: text of a batch that is encoded and decoded at once: a task's memory follows from this, not from the rows of a batch
SLICE_BYTES = 1 << 20

EACH_BYTE = "panelkit-each-byte"
codecs.register_error(EACH_BYTE, lambda e: ("�", e.start + 1))


class Model(NamedTuple):
    pieces: list[tuple[str, float, int]]
    add_prefix: bool
    unknown_surface: str
    digest: str


def _fields(data: bytes):
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


def read_model(path: str) -> Model:
    """The pieces of a model file; raises for models that normalise text or don't merge."""
    pieces, add_prefix, surface = [], True, " ⁇ "
    with open(path, "rb") as f:
        content = f.read()
    for number, value in _fields(content):
        if number == 1:
            found = dict(_fields(value))
            pieces.append((found[1].decode(), struct.unpack("<f", found.get(2, bytes(4)))[0], found.get(3, NORMAL)))
        elif number == 2:
            found = dict(_fields(value))
            if found.get(3) != 2:
                raise ValueError("not a merge-type model")
            surface = found[44].decode() if 44 in found else surface
        elif number == 3:
            found = dict(_fields(value))
            add_prefix = bool(found.get(3, 1))
            if found.get(2) or found.get(4, 1) or not found.get(5, 1):
                raise ValueError("models that normalise texts are not supported")
    if any(kind in (USER_DEFINED, UNUSED) for _, _, kind in pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    return Model(pieces, add_prefix, surface, hashlib.sha256(content).hexdigest())


class Encoder:
    """Tokens of a text and text of tokens, for one model."""

    def __init__(self, model: Model):
        import ahocorasick

        self.add_prefix = model.add_prefix
        self.size = len(model.pieces)
        self.unknown = next(i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN)
        self.texts = [p[0] for p in model.pieces]
        self.ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind == NORMAL}
        self.scores = {p: model.pieces[i][1] for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.words: dict[str, bytes] = {}  # a word after a blank, or a line feed and another unit: its tokens as int32
        self.older_words: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.lengths = list(map(len, self.texts))
        self.trie = ahocorasick.Automaton()
        reachable = {p for p in self.ids if self.merge(p) == [p]}
        for p in reachable:
            self.trie.add_word(p, self.ids[p])
        self.trie.make_automaton()
        self.shorter = {
            self.ids[p]: next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in reachable), None) for p in reachable
        }
        self.by_text = {p: self.ids[p] for p in reachable}
        self.marks = {c: self.ids[c] for c in ".,;:!?)\"'" if c in reachable}
        self.longest_piece = max(map(len, reachable))
        single = "".join(map(re.escape, (p for p in self.ids if len(p) == 1)))
        self.strange = re.compile(f"([^{single}])")
        # no piece has a blank after something else: merging never passes a place between a word and a blank
        inner = any(BLANK in p.lstrip(BLANK) for p in self.ids)
        stops = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        self.by_line = not inner and self.add_prefix and "\n" in stops and 10 in self.bytes
        self.units = None if inner else re.compile(f"{BLANK}+[^{BLANK}{stops}]*|[^{BLANK}{stops}]+" + (f"|[{stops}]" if stops else ""))
        raw = []
        for piece, _, kind in model.pieces:
            if kind == BYTE:
                raw.append(bytes([int(piece[3:5], 16)]))
            elif kind == CONTROL:
                raw.append(b"")
            else:
                raw.append((model.unknown_surface if kind == UNKNOWN else piece.replace(BLANK, " ")).encode())
        self.raw = raw
        self.kinds = [p[2] for p in model.pieces]
        self.line_feed = array.array("i", [self.bytes.get(10, self.unknown)]).tobytes()
        self.control = {i for i, kind in enumerate(self.kinds) if kind == CONTROL}

    def merge(self, text: str) -> list[str]:
        """The pieces that are left when the best adjacent pair is merged, the leftmost of equals, until none fits."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            a, b = self.texts[left], self.texts[right]
            known = self.pairs[key] = self.merge(a + b) == [a, b]
        return known

    def _backtrack(self, text: str) -> list[int]:
        """Tokens of a text whose characters are all pieces.

        The leftmost longest matches are taken as long as neighbours are compatible; from the first that is not,
        shorter ones are tried, and the places from which nothing fits are marked.
        """
        lengths, pairs, compatible, shorter = self.lengths, self.pairs, self.compatible, self.shorter
        tokens: list[int] = []
        place, last, token = 0, None, None
        for _, token in self.trie.iter_long(text):
            if last is not None:
                known = pairs.get(last << 32 | token)
                if not (compatible(last, token) if known is None else known):
                    break
            tokens.append(token)
            place += lengths[token]
            last = token
        else:
            return tokens
        n, longest = len(text), self._longest
        failed = None  # a bit for each place from which nothing fits
        while True:
            while token is not None:
                end = place + lengths[token]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    known = True if last is None else pairs.get(last << 32 | token)
                    if compatible(last, token) if known is None else known:
                        break
                token = shorter[token]
                while token is None:  # back to the token before, in a shorter form
                    failed = bytearray(n // 8 + 1) if failed is None else failed
                    failed[place >> 3] |= 1 << (place & 7)
                    gone = tokens.pop()
                    place -= lengths[gone]
                    token, last = shorter[gone], tokens[-1] if tokens else None
            tokens.append(token)
            place, last = end, token
            if place == n:
                return tokens
            token = longest(text, place)

    def _longest(self, text: str, place: int) -> int:
        """The longest piece that begins at a place: as far as the automaton's branches go, back to a piece's end."""
        part = text[place:place + self.longest_piece]
        size = self.trie.longest_prefix(part)
        found = self.by_text.get(part[:size])
        while found is None:
            size -= 1
            found = self.by_text.get(part[:size])
        return found

    def _unit(self, unit: str) -> bytes:
        if not self.strange.search(unit):
            return array.array("i", self._backtrack(unit)).tobytes()
        tokens: list[int] = []
        for i, part in enumerate(self.strange.split(unit)):
            if i % 2:  # a character that is no piece is spelled in bytes, or unknown
                spelled = [self.bytes.get(b) for b in part.encode()]
                tokens.extend([self.unknown] if None in spelled else spelled)
            elif part:
                tokens.extend(self._backtrack(part))
        return array.array("i", tokens).tobytes()

    def _remembered(self, key: str) -> bytes:
        """Tokens of a unit that is not among the words met lately."""
        found = self.older_words.get(key)
        if found is None:
            found = self._with_mark(key)
        if found is None:
            found = self._unit(key[1:] if key[:1] == "\n" else BLANK + key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self.words) >= WORDS:
                self.older_words, self.words = self.words, {}
            self.words[key] = found
        return found

    def _with_mark(self, key: str) -> bytes | None:
        """Tokens of a word that is remembered without the mark at its end, if the mark's token may follow them."""
        mark = self.marks.get(key[-1:])
        word = self.words.get(key[:-1]) if mark is not None else None
        if not word or not self.compatible(int.from_bytes(word[-4:], sys.byteorder), mark):
            return None
        return word + mark.to_bytes(4, sys.byteorder)

    def _known(self, keys: list[str]) -> list[bytes]:
        found = list(map(self.words.get, keys))
        if None in found:
            found = [self.words.get(k) or self._remembered(k) if f is None else f for k, f in zip(keys, found)]
        return found

    def _by_units(self, text: str) -> list[bytes]:
        """The tokens of text whose blanks stand for themselves, in its units."""
        units = self.units.findall(text) if self.units else [text]
        return self._known([u[1:] if u[0] == BLANK and u[1:2] not in ("", BLANK, "\n") else "\n" + u for u in units])

    def encode(self, text: str) -> np.ndarray:
        """Numbers of the tokens, int32."""
        if not text:
            return np.zeros(0, np.int32)
        parts: list[bytes] = []
        if not self.by_line or BLANK in text:
            parts = self._by_units(BLANK * self.add_prefix + text.replace(" ", BLANK))
        else:
            for number, line in enumerate(text.split("\n")):
                words = line.split(" ")
                if number:  # the first word of a later line has no blank before it
                    parts.append(self.line_feed)
                    if words[0]:
                        parts += self._known(["\n" + words[0]])
                    del words[0]
                parts += self._by_units(BLANK + BLANK.join(words)) if "" in words else self._known(words)
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids) -> str:
        """Text of tokens; bytes that are no UTF-8 become U+FFFD each, ids out of range, and null ones in a list (-1), read as unknown."""
        raw = self.raw
        if any(not 0 <= i < self.size for i in (min(ids, default=0), max(ids, default=0))):
            ids = [i if 0 <= i < self.size else self.unknown for i in ids]
        parts = list(map(raw.__getitem__, ids))
        if self.add_prefix:
            for n, token in enumerate(ids):  # one blank before the first text is the prefix
                if self.kinds[token] != CONTROL:
                    if self.kinds[token] == NORMAL and parts[n][:1] == b" ":
                        parts[n] = parts[n][1:]
                    break
        if self.control.isdisjoint(ids):
            return b"".join(parts).decode("utf-8", EACH_BYTE)
        runs: list[list[bytes]] = [[]]  # a character's bytes are not read across a control token
        for part, token in zip(parts, ids):
            if token in self.control:
                runs.append([])
            else:
                runs[-1].append(part)
        return "".join(b"".join(run).decode("utf-8", EACH_BYTE) for run in runs)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(model: Model) -> Encoder:
    """The worker's encoder of a model, made once."""
    if model.digest not in _ENCODERS:
        _ENCODERS[model.digest] = Encoder(model)
    return _ENCODERS[model.digest]


def _encoded(encoder: Encoder, texts: pa.Array) -> pa.Array:
    found = [encoder.encode(text.as_py() or "") for text in texts]
    offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))


def _decoded(decoder: Encoder, lists: pa.Array) -> pa.Array:
    flat = lists.flatten()  # null lists have no values
    ids = flat.fill_null(-1).to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    return pa.array([decoder.decode(x.tolist()) for x in np.split(ids, ends[:-1])] if len(lists) else [], pa.string())


def _coded(encoder: Encoder, batches):
    """Batches whose last column is the text, with ids and decoded in its place, in parts of SLICE_BYTES of text and a row at most."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // SLICE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for start, end in zip(edges, edges[1:]):
            *kept, texts = batch.slice(start, end - start).columns
            ids = _encoded(encoder, texts)
            yield pa.RecordBatch.from_arrays([*kept, ids, _decoded(encoder, ids)], [*batch.schema.names[:-1], "ids", "decoded"])


class Codec:
    """Encoding and decoding as column functions, or of a table's texts, for the model file at `path` on the driver.

    Null texts encode like empty ones, to no tokens, and null lists decode to an empty text. Nothing is cut: a text of
    any length is encoded in its row.
    """

    def __init__(self, spark: SparkSession, path: str):
        shared = self._shared = spark.sparkContext.broadcast(read_model(path))

        @F.arrow_udf("array<int>")
        def encode(texts: pa.Array) -> pa.Array:
            return _encoded(_encoder(shared.value), texts)

        @F.arrow_udf("string")
        def decode(lists: pa.Array) -> pa.Array:
            return _decoded(_encoder(shared.value), lists)

        self._encode, self._decode = encode, decode

    def encode(self, text: str | Column = "text") -> Column:
        return self._encode(text)

    def decode(self, ids: str | Column = "ids") -> Column:
        return self._decode(ids)

    def coded(self, docs: DataFrame, *keep: str) -> DataFrame:
        """The named columns, ids and decoded, the text that the ids give back, of every row.

        The column functions hold the results of a whole batch of rows; here they leave a task in small parts.
        """
        shared = self._shared
        rows = docs.select(*keep, F.col("text").cast("string"))
        schema = T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
        return rows.mapInArrow(lambda batches: _coded(_encoder(shared.value), batches), schema)
