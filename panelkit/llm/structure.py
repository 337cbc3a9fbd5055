"""Conversation structure repair by grammar-compressed dynamic programming (operator 12).

A conversation becomes a string of symbols, one per row: the initial of its role and its fault. Conversations share
most of their strings, and these most of their parts, so a Re-Pair grammar is built over the distinct strings: round by
round the most frequent pairs of neighbours become symbols of their own. Every symbol has one transfer matrix from
structure state to structure state, in min-plus algebra, whose entries carry the edits as a rope. A rule's matrix is the
product of the two below it, computed once, bottom-up, and used for all conversations that hold the rule. The product
over a conversation gives its cheapest edits, the least in ASCII among equally cheap ones.

Rows are cut into chunks of CHUNK symbols on the way, so that a conversation with a third of all rows is read, coded and
compressed by many tasks. Only its digest (one hash over all of its text) is computed in sequence, as a stream.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelkit.functions.durable import settle
from panelkit.llm.text import BLANKS

#: symbols of a chunk of a conversation
CHUNK = 65_536
#: rounds of Re-Pair, and pairs looked at in each; what is left unpaired is multiplied symbol by symbol
ROUNDS, CHOICE = 12, 256
#: strings whose matrices a task remembers
REMEMBERED = 50_000

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
#: structure states after the roles so far: nothing, system, user, assistant; moves by the initial of the next role
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTED = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
#: the first symbol of a rule; all symbols are characters of a string
RULE = 0x4E00
MAX_RULES = 0x9000 - RULE

# ---------------------------------------------------------------------------------------------------------- ropes


class Rope:
    """Two ropes or strings in a row; parts are shared, never copied."""

    __slots__ = ("left", "right", "size")

    def __init__(self, left, right, size: int):
        self.left, self.right, self.size = left, right, size


def _size(rope) -> int:
    return len(rope) if isinstance(rope, str) else rope.size


def joined(left, right):
    a, b = _size(left), _size(right)
    if not a or not b:
        return left if a else right
    return left + right if a + b <= 16 and isinstance(left, str) and isinstance(right, str) else Rope(left, right, a + b)


def flat(rope) -> str:
    parts, waiting = [], [rope]
    while waiting:
        r = waiting.pop()
        if isinstance(r, str):
            parts.append(r)
        else:
            waiting += (r.right, r.left)
    return "".join(parts)


def before(a, b) -> bool:
    """Whether a's text comes before b's; parts that both share are not read."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if isinstance(x, str) and isinstance(y, str):
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            if len(x) > n:
                left.append(x[n:])
            elif len(y) > n:
                right.append(y[n:])
        elif isinstance(y, str) or (not isinstance(x, str) and x.size >= y.size):
            left += (x.right, x.left)
            right.append(y)
        else:
            right += (y.right, y.left)
            left.append(x)
    return bool(right)


# ------------------------------------------------------------------------------------------------------- matrices


def _better(new, old) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and before(new[1], old[1]))


def product(a, b):
    """Min-plus product of matrices of (cost, edits) or None; equally cheap edits are compared as text.

    Between the same states and over the same rows no edits begin with others of the same cost (they would go on with
    insertions, which cost), so the least text of a product is that of the least parts.
    """
    out = [[None] * len(MOVES) for _ in a]
    for i, row in enumerate(a):
        for k, first in enumerate(row):
            if first is None:
                continue
            for j, second in enumerate(b[k]):
                if second is None:
                    continue
                cost, old = first[0] + second[0], out[i][j]
                if old is None or cost <= old[0]:
                    new = (cost, joined(first[1], second[1]))
                    if _better(new, old):
                        out[i][j] = new
    return out


def _insertions():
    """Roles inserted from state to state; no cheapest edits go through a state twice."""
    out = [[None] * len(MOVES) for _ in MOVES]
    for i in range(len(MOVES)):
        out[i][i], state, edits = (0, ""), i, ""
        while True:
            state = next(MOVES[state][r] for r in "ua" if r in MOVES[state])
            edits += INSERT
            if out[i][state] is not None:
                break
            out[i][state] = (COST[INSERT] * len(edits), edits)
    return out


INSERTIONS = _insertions()


def symbol(letter: str):
    """Matrix of one row: insertions before it, then the row kept, with another role, or deleted. Letters are b (blank)
    and d (duplicate), which go, and the role's initial (o: any other), in upper case for a truncated text."""
    row = [[None] * len(MOVES) for _ in MOVES]
    for i, moves in enumerate(MOVES):
        row[i][i] = (COST[DELETE], DELETE)
        if letter not in "bd":
            extra = TRUNCATED if letter.isupper() else 0
            for role, j in moves.items():
                if role == letter.lower():
                    row[i][j] = (COST[KEEP] + extra, KEEP)
                elif role in NAMES:
                    row[i][j] = (COST[REROLE] + extra, REROLE)
    return product(INSERTIONS, row)


class Grammar:
    """Rules of Re-Pair, each a pair of earlier symbols, and the matrices of all symbols."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.matrices = {c: symbol(c) for c in "bdsuaoSUAO"}
        for n, (left, right) in enumerate(rules):
            self.matrices[chr(RULE + n)] = product(self.matrices[left], self.matrices[right])
        self.known: dict[str, list] = {}

    def matrix(self, text: str):
        """Matrix of a string of letters: its symbols' matrices, multiplied in pairs of neighbours."""
        found = self.known.get(text)
        if found is None:
            line = [self.matrices[c] for c in paired(text, self.rules, 0)]
            while len(line) > 1:
                line = [product(*line[i:i + 2]) if i + 1 < len(line) else line[i] for i in range(0, len(line), 2)]
            found = line[0]
            if len(text) <= 256 and len(self.known) < REMEMBERED:
                self.known[text] = found
        return found


def paired(text: str, rules: list[str], first: int) -> str:
    for n, pair in enumerate(rules, first):
        if len(text) < 2:
            break
        text = text.replace(pair, chr(RULE + n))
    return text


def cheapest(vector) -> tuple[int, str]:
    """Cost and edits of a whole conversation from the vector of its first state."""
    ends = [e for e in (product([vector], INSERTIONS)[0][s] for s in ACCEPTED) if e is not None]
    best = ends[0]
    for e in ends[1:]:
        best = e if _better(e, best) else best
    return best[0], flat(best[1])


START = [(0, ""), None, None, None]

# --------------------------------------------------------------------------------------------------------- Re-Pair


def repair_grammar(texts: DataFrame) -> list[str]:
    """Rules over the distinct strings of the column `symbols`: a round takes the most frequent pair, then others that
    share no symbol with those taken, so that their counts hold as well; it ends when no pair occurs twice."""
    rules: list[str] = []
    current = settle(texts.select("symbols").distinct())

    def count(batches):
        pairs: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = Counter(map("".join, zip(text, text[1:])))
                for pair in own:
                    if pair[0] == pair[1]:
                        own[pair] = text.count(pair)  # without overlaps
                pairs.update(own)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(pairs.keys(), pa.string()), "n": pa.array(pairs.values(), pa.int64())})

    for _ in range(ROUNDS):
        best = (
            current.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
            .orderBy(F.desc("n"), "pair").limit(CHOICE).collect()
        )
        taken, new = set(), []
        for r in best:
            if not taken & set(r["pair"]) and len(rules) + len(new) < MAX_RULES:
                taken |= set(r["pair"])
                new.append(r["pair"])
        if not new:
            break
        first = len(rules)
        rules += new

        def shorten(batches, new=new, first=first):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"symbols": pa.array([paired(t, new, first) for t in batch.column(0).to_pylist()], pa.string())})

        current = settle(current.mapInArrow(shorten, "symbols string").filter("length(symbols) > 1"))
    return rules


# ---------------------------------------------------------------------------------------------------- conversations


def plain(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text; a null role or text is one space."""
    return conversations.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults by the checksum of conversation and turn: dropped, emptied, without sentence ends, repeated or
    given to the user; a null id or turn is one space there, a null role or text everywhere."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    return (
        plain(conversations).withColumn("_draw", draw).filter("_draw <> 0")
        .withColumns({
            "text": F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
            "role": F.when(F.col("_draw") == 4, "user").otherwise(F.col("role")),
            "_copy": F.explode(F.when(F.col("_draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
        })
        .drop("_draw", "_copy")
    )


def _letter() -> Column:
    """b for a blank text, else the initial of the role, in upper case where the text doesn't end a sentence."""
    bare = F.btrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(bare == "", "b").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), known).otherwise(F.upper(known))


def chunks(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, part, chunk and symbols: the conversations' rows by turn (null first), role and digest of the text, as
    letters. Equal rows are counted before they move; all but the first of a conversation's rows of the same role
    and text are d."""
    lettered = rows.select("conv_id", "turn", "role", F.sha1("text").alias("digest"), _letter().alias("letter"))
    unique = settle(lettered.groupBy(*lettered.columns).agg(F.count("*").alias("n")))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    again = settle(
        unique.filter("letter <> 'b'").groupBy("conv_id", "role", "digest")
        .agg(F.min(place).alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    )
    same = F.col("u.conv_id").eqNullSafe(F.col("a.conv_id")) & (F.col("u.role") == F.col("a.role")) & (F.col("u.digest") == F.col("a.digest"))
    coded = unique.alias("u").join(again.alias("a"), same, "left").select(
        "u.conv_id", "u.turn", "u.role", "u.digest", "n",
        F.when((F.col("letter") != "b") & (place_of("u") != F.col("_first")), "d").otherwise(F.col("letter")).alias("letter"),
    )
    order = ["conv_id", "turn", "role", "digest"]
    in_order = coded.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches):
        own, text, at, part = None, "", 0, None
        out: list[tuple] = []
        for batch in batches:
            for conv, n, letter, part in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or own[0] != conv:
                    if own is not None:
                        out.append((own[0], part, at, text))
                    own, text, at = (conv,), "", 0
                run = letter
                while True:
                    text += run
                    n -= len(run)
                    if len(text) >= chunk:
                        out.append((conv, part, at, text))
                        text, at = "", at + 1
                    if not n:
                        break
                    run = ("b" if letter == "b" else "d") * min(n, chunk - len(text))
            if len(out) >= 1000:
                yield _batch(CHUNKS, out)
                out = []
        if own is not None:
            out.append((own[0], part, at, text))
        if out:
            yield _batch(CHUNKS, out)

    return in_order.select("conv_id", "n", "letter", F.spark_partition_id().alias("part")).mapInArrow(
        cut, "conv_id long, part int, chunk long, symbols string").filter("symbols <> ''")


def place_of(alias: str) -> Column:
    turn = F.col(f"{alias}.turn")
    return F.struct(turn.isNotNull().alias("known"), F.coalesce(turn, F.lit(0)).alias("turn"))


CHUNKS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("chunk", pa.int64()), ("symbols", pa.string())])
REPORT = pa.schema([("conv_id", pa.int64())] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                   + [("audit", pa.string()), ("repaired_sha256", pa.string())])
ROWS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class Repaired:
    """One conversation while its chunks, then its rows, come by."""

    def __init__(self, conv):
        self.conv, self.vector, self.audit, self.at, self.place = conv, START, None, 0, 0
        self.counts: Counter = Counter()
        self.turns, self.last_turn, self.span = 0, None, None
        self.illegal, self.initial, self.next_role = 0, None, "u"
        self.hash = hashlib.sha256()

    def chunk(self, symbols: str, grammar: Grammar) -> None:
        self.counts.update(symbols)
        self.vector = product([self.vector], grammar.matrix(symbols))[0]

    def settle(self) -> None:
        self.cost, self.audit = cheapest(self.vector)

    def _emit(self, role: str, text: str, edit: str) -> tuple:
        self.hash.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        self.place += 1
        return self.conv, self.place, role, text, edit

    def _turned(self) -> str:
        role, self.next_role = self.next_role, "a" if self.next_role == "u" else "u"
        return NAMES[role]

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.at += 1
            yield self._emit(self._turned(), "", INSERT)

    def row(self, turn, role: str, text: str) -> Iterator[tuple]:
        """The rows that come out before and for this one."""
        if turn is not None:
            self.turns += turn != self.last_turn
            self.last_turn, self.span = turn, (turn if self.span is None else self.span[0], turn)
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in ("su", "ua", "au")
        self.initial = role[:1]
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == KEEP:
            if role[0] != "s":
                self._turned()
            yield self._emit(role, text, edit)
        elif edit == REROLE:
            yield self._emit(self._turned(), text, edit)

    def report(self) -> tuple:
        gaps = self.span[1] - self.span[0] + 1 - self.turns if self.span else 0
        gaps = (gaps + 2**63) % 2**64 - 2**63  # as longs do beyond their range
        cut = sum(n for c, n in self.counts.items() if c.isupper())
        return (self.conv, gaps, self.counts["b"], self.counts["d"], cut, self.illegal, self.cost, self.audit, self.hash.hexdigest())


def _edited(rows: DataFrame, ids: DataFrame | None, want: pa.Schema, chunk: int) -> DataFrame:
    """Chunks and rows of a conversation meet in one partition, chunks first, and pass in order."""
    symbols = settle(chunks(rows, chunk))
    rules = repair_grammar(symbols)
    every = [symbols.withColumn("kind", F.lit(1)), rows.select("conv_id", "turn", "role", "text", F.sha1("text").alias("digest"), F.lit(2).alias("kind"))]
    if ids is not None:
        every.append(ids.select("conv_id").distinct().withColumn("kind", F.lit(0)))
    met = every[0]
    for e in every[1:]:
        met = met.unionByName(e, allowMissingColumns=True)
    in_order = met.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", "chunk", "turn", "role", "digest")
    reports = want is REPORT

    def edit(batches):
        grammar, own = Grammar(rules), None
        out: list[tuple] = []

        def finish():
            if own.audit is None:
                own.settle()
            out.extend([] if reports else own.inserted())
            if reports:
                for _ in own.inserted():
                    pass
                out.append(own.report())

        for batch in batches:
            for conv, kind, text_symbols, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or own.conv != conv:
                    if own is not None:
                        finish()
                    own = Repaired(conv)
                if kind == 1:
                    own.chunk(text_symbols, grammar)
                elif kind == 2:
                    if own.audit is None:
                        own.settle()
                    for r in own.row(turn, role, text):
                        if not reports:
                            out.append(r)
                if len(out) >= 2000:
                    yield _batch(want, out)
                    out.clear()
        if own is not None:
            finish()
        if out:
            yield _batch(want, out)

    types = {pa.int64(): "long", pa.string(): "string"}
    return in_order.select("conv_id", "kind", "symbols", "turn", "role", "text").mapInArrow(
        edit, ", ".join(f"{f.name} {types[f.type]}" for f in want))


def report(rows: DataFrame, ids: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated and illegal rows, cost, audit and repaired_sha256.

    Rows (conv_id, turn, role, text) go by turn, null turns first; equal turns by role and digest of the text. A null
    id is a conversation like any other, a null role or text is one space. A role counts by its first letter; any other than
    s, u and a can't be kept. `ids` names conversations that may have no rows left: zeros, an empty audit, the
    digest of nothing. Without rows and ids there is no result. Further columns are left aside.
    """
    return _edited(plain(rows), ids, REPORT, chunk)


def repaired(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The rows after the cheapest edits: conv_id, place (from 1), role, text and edit (K, R or I)."""
    return _edited(plain(rows), None, ROWS, chunk)
