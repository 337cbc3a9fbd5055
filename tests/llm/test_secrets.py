import hashlib
import random
import re

from panelkit.llm import registry, secrets
from panelkit.llm.text import table

PATTERNS = [
    ("assign", re.compile(r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]


def _brute(text):
    found = [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for n, (kind, p, g, least) in enumerate(PATTERNS)
             for m in p.finditer(text or "") if len(m[g]) >= least]
    return [s for _, _, s in sorted(found)]


def _text(rng):
    parts = ["password=", "PassWd : '", "api_key\":\"", "APIKEY=", "token = ", "ſecret=", "secret:", "AKIA", "ABCDEF0123456789", "0123456789abcdef",
             "deadbeefdeadbeef", " ", "\n", "é", "x", "\"", "Kelvin", "A1b2C3d4", "=", "-", "abc"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))


def test_base_spans_match_the_patterns():
    rng = random.Random(5)
    for _ in range(20_000):
        text = _text(rng)
        assert [f"{k}:{a}:{b}" for a, b, k, _ in secrets.base_spans(text)] == _brute(text), text


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    rows = registry.op5_secrets(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = _brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("novel")] == base
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex"))


def test_novel_strings_in_sensitive_context(spark):
    code = "def connect(host, port):\n    return open_session(host, port, timeout=30)\n" * 3
    secret = "q7Xz91LmTt04RvBw82Kd"
    texts = [
        code + f"Authorization bearer {secret}\n" + code,
        code + "the key idea of international_conference_2024 is\n" + code + " international_conference_2024\n" * 3,
        code + f"nothing to see {secret}\n",
        "private key " + "z" * 40 + "11",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.scan(docs).collect()}
    at = texts[0].index(secret)
    assert rows == {0: [("novel", at, at + len(secret))], 1: [], 2: [], 3: []}
    assert b"international_conference" in secrets.dictionary(docs) or b"connect" in secrets.dictionary(docs)
    assert secret.encode() not in secrets.dictionary(docs)


def test_every_value_in_reach_is_measured(spark):
    """Values without digits or without letters, and values behind a key name or another word that is a value too."""
    values = ["qXzwLmTtKvRvBwhJKdPs", "83017465920418375629", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzzPLMNOKEY", "q7Xz91LmTt04RvBw82Kd", "Zk3vN8rTq1LwXy6Pb0Hs"]
    before = ["the bearer ", "auth: ", '{"auth": {"aws_secret_access_key": "', "auth configuration_id ", "auth secret_key_of_service="]
    texts = [f"some words before\n{b}{v}" + ('"}}' if b[0] == "{" else "\n") for b, v in zip(before, values)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.scan(docs).collect()}
    for i, (text, value) in enumerate(zip(texts, values)):
        at = text.index(value)
        assert any(kind == "novel" and a <= at and b == at + len(value) for kind, a, b in rows[i]), text
    clean = {r.doc_id: r.text for r in secrets.masked_documents(docs).collect()}
    assert not any(v in clean[i] for i, v in enumerate(values))
    assert secrets.candidates("secretoken\nkey\n" + "a" * 16 + " b" * 20 + " " + "c" * 16, []) == [(15, 31)]


def test_edges_and_masking(spark, edge, empty):
    assert secrets.scan(empty).count() == 0 and secrets.masked_documents(empty).count() == 0
    rows = secrets.scan(edge).collect()
    assert len(rows) == edge.count() and sum(len(r.spans) for r in rows) == 1
    clean = secrets.masked_documents(edge)
    assert clean.columns == edge.columns
    old = {(str(r.doc_id), r.lang): r for r in edge.collect()}
    for r in clean.collect():
        before = old[str(r.doc_id), r.lang]
        if r.doc_id == 8:
            assert "password = [SECRET]\n" in r.text and r.n_chars == len(r.text)
        else:
            assert (r.text, r.n_chars) == (before.text, before.n_chars)
    assert secrets.mask("k=abcdef x", [(0, 8, "assign", 2), (3, 8, "hex", 3)], "[]") == "k=[] x"


def _long(n, seed=4):
    """Lines with base secrets, novel strings, and runs with many equals signs."""
    rng = random.Random(seed)
    draw = lambda k: "".join(rng.choices("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789", k=k))
    lines = [rng.choice([f"password = {draw(12)}", f"auth bearer {draw(24)}", f"private key {draw(20)}={draw(18)}", "plain words only"]) for _ in range(n)]
    return "\n".join(lines)


def test_spans_are_those_of_a_plain_search():
    text, novelty = _long(120), secrets.Novelty(b"connect session timeout " * 20)
    base = secrets.base_spans(text)

    def around(a, b):
        low, high = max(0, a - secrets.AROUND), min(len(text), b + secrets.AROUND)
        hidden = {i for s in [(a, b), *base] for i in range(s[0], s[1])}
        return "".join(text[i] for i in range(low, high) if i not in hidden)

    expected, last = [], None
    words = [m.end(1) for m in secrets.SENSITIVE.finditer(text)]
    for m in secrets.VALUE.finditer(text):
        for a in [m.start(), *(k + 1 for k in range(m.start(), m.end() - 16) if text[k] == "=")]:
            near = [w for w in words if w <= a - 1 and a - 1 - w <= secrets.REACH]
            if not near or "\n" in text[max(near):a - 1] or any(s[0] < m.end() and a < s[1] for s in base) or last == m.end():
                continue
            added, own = novelty.added(around(a, m.end()), text[a:m.end()])
            if added / own >= secrets.NOVEL:
                expected.append((a, m.end()))
                last = m.end()
    assert expected and [(a, b) for a, b, k, _ in secrets.spans_of(text, novelty) if k == "novel"] == expected


def test_time_follows_the_length_of_a_text():
    import time

    novelty = secrets.Novelty(b"")

    def seconds(text):
        began = time.process_time()
        secrets.spans_of(text, novelty)
        return time.process_time() - began

    seconds(_long(100))
    assert seconds(_long(20_000)) < 20 * seconds(_long(2000)) + 0.5
    run = lambda n: "key " + "key=" * n
    assert seconds(run(8000)) < 20 * seconds(run(800)) + 0.5


def test_long_values_are_measured_in_pieces():
    rng = random.Random(2)
    value = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=5000))
    novelty = secrets.Novelty(b"")
    text = f"auth bearer {value} end\nauth bearer {'ab' * 2500} end"
    found = [(a, b) for a, b, k, _ in secrets.spans_of(text, novelty) if k == "novel"]
    assert found == [(12, 5012)]
