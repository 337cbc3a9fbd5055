import functools
import hashlib
import itertools
import random

import pytest

from panelkit.llm import structure

SCHEMA = "conv_id long, turn long, role string, text string"


def least(letters):
    """Cheapest edits from the last row back, as text: independent of matrices and ropes."""

    @functools.cache
    def rest(at, state, inserts):
        found = []
        if at == len(letters) and state in (0, 3):
            found.append((0, ""))
        if inserts < 3:
            for role in "ua":
                if role in structure.MOVES[state]:
                    cost, edits = rest(at, structure.MOVES[state][role], inserts + 1)
                    found.append((cost + 2, "I" + edits))
        if at < len(letters):
            letter = letters[at]
            cost, edits = rest(at + 1, state, 0)
            found.append((cost + 3, "D" + edits))
            for role, after in structure.MOVES[state].items():
                if letter in "bd" or (role == "s" and letter.lower() != "s"):
                    continue
                cost, edits = rest(at + 1, after, 0)
                kept = role == letter.lower()
                found.append((cost + (0 if kept else 2) + letter.isupper(), ("K" if kept else "R") + edits))
        return min(found, default=(10**9, ""))

    return rest(0, 0, 0)


def test_all_short_strings():
    grammar = structure.Grammar(["ua", "一一", "uu", "bd", "Ua"])
    for n in range(5):
        for letters in map("".join, itertools.product("bsuaoSUA", repeat=n)):
            vector = structure.product([structure.START], grammar.matrix(letters))[0] if letters else structure.START
            assert structure.cheapest(vector) == least(letters), letters


def test_long_strings_in_any_chunks():
    draw = random.Random(5)
    grammar = structure.Grammar(["ua", "一一", "丁丁"])
    for n in (30, 200):
        letters = "".join(draw.choices("bdsuaoSUAO", [1, 1, 1, 9, 9, 1, 1, 1, 1, 1], k=n))
        for size in (1, 7, n):
            vector = structure.START
            for at in range(0, n, size):
                vector = structure.product([vector], grammar.matrix(letters[at:at + size]))[0]
            assert structure.cheapest(vector) == least(letters)


def test_ropes_compare_as_their_texts():
    draw = random.Random(1)
    for _ in range(300):
        ropes = ["K" * draw.randrange(20) + draw.choice("DIR") for _ in range(6)]
        for _ in range(12):
            ropes.append(structure.joined(*draw.choices(ropes, k=2)))
        a, b = draw.choices(ropes, k=2)
        assert structure.before(a, b) == (structure.flat(a) < structure.flat(b))


def by_hand(rows):
    """The report of one conversation's rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha1(r[2].encode()).hexdigest()))
    letters, seen, counts, illegal, last = "", set(), {"b": 0, "d": 0, "t": 0}, 0, None
    for turn, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        letter = "b" if not bare else "d" if (role, text) in seen else initial if bare[-1] in ".!?" else initial.upper()
        counts["t" if letter.isupper() else letter if letter in "bd" else "-"] = counts.get("t" if letter.isupper() else letter if letter in "bd" else "-", 0) + 1
        seen.add((role, text))
        illegal += last is not None and last + role[:1] not in ("su", "ua", "au")
        letters, last = letters + letter, role[:1]
    cost, audit = least(letters)
    at, state, lines = 0, 0, []
    for edit in audit:
        if edit != "I":
            turn, role, text = rows[at]
            at += 1
        if edit == "D":
            continue
        if edit == "K":
            state = structure.MOVES[state][role[0]]
        else:
            name = next(r for r in "ua" if r in structure.MOVES[state])
            state, role = structure.MOVES[state][name], structure.NAMES[name]
        lines.append(f"{role}:{'' if edit == 'I' else text}")
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, digest), lines


def conversations():
    draw = random.Random(3)
    texts = ["Yes.", "No", "", " \t", "Why?", "Ünïcode 😀!", "line\nbreak"]
    roles = ["user", "assistant", "system", "tool", "", " "]
    rows = [(c, draw.choice([None, *range(6)]), draw.choices(roles, [9, 9, 3, 1, 1, 1])[0], draw.choice(texts))
            for c in [None, *range(40)] for _ in range(draw.randrange(1, 12))]
    # one conversation that holds a third of all rows, many of them the same
    rows += [(99, t // 3, ["user", "assistant"][t % 2], f"turn {t % 40}.") for t in range(len(rows) // 2)]
    return rows


@pytest.mark.parametrize("chunk", [1, 5, 65_536])
def test_report_and_rows(chunk, spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = {r.conv_id: tuple(r)[1:] for r in structure.report(df, chunk=chunk).collect()}
    expected = {c: by_hand([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert found == {c: e[0] for c, e in expected.items()}
    if chunk == 5:
        lines: dict = {}
        for r in sorted(structure.repaired(df, chunk).collect(), key=lambda r: r.place):
            lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert lines == {c: e[1] for c, e in expected.items() if e[1]}


def test_nulls_nothing_left_and_no_rows(spark):
    rows = [(1, None, None, None), (1, None, "user", "Hi."), (2, 5, "user", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    ids = spark.createDataFrame([(7,), (7,), (None,)], "conv_id long")
    found = {r.conv_id: tuple(r)[1:] for r in structure.report(df, ids).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert found[7] == found[None] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert found[1] == by_hand([(None, " ", " "), (None, "user", "Hi.")])[0]
    assert found[2] == (0, 1, 0, 0, 0, 3, "D", nothing)
    empty = spark.createDataFrame([], SCHEMA)
    assert structure.report(structure.damaged(empty), empty).collect() == [] and structure.repaired(empty).collect() == []


def test_extra_columns_and_rules(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t, "ua"[t % 2] * 2, "Fine.") for i in range(20) for t in range(2 + i)], SCHEMA)
    clash = df.withColumns({c: F.lit(1) for c in ("part", "chunk", "symbols", "kind", "digest", "letter", "n")})
    assert sorted(structure.report(clash).collect()) == sorted(structure.report(df).collect())
    rules = structure.repair_grammar(structure.chunks(df))
    assert rules[0] in ("ad", "dd", "ud", "ua")
