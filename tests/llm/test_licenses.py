import re

from pyspark.sql import functions as F

from panelkit.llm import licenses


def _words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) if w]


def _scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scan(docs).collect()}


def test_phrases(spark):
    texts = ["The MIT-License; mit\nlicense MIT Licenses", "general public general public license", "ÄMIT license mit licensé", "mit", "license mit license",
             "apache license general public license apache"]
    for i, r in _scan(spark, texts).items():
        words, places, labels = _words(texts[i]), [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            found = [k for k in range(len(words)) if words[k:k + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert r.score == (1.0 if places else 0.0)


def test_passages_with_insertions(spark):
    bsd, isc = licenses.PASSAGES[3][0], licenses.PASSAGES[4][0]
    words = bsd.split()
    texts = [
        "before " * 50 + bsd + " after",
        " ".join(words[:20] + ["inserted", "words"] + words[22:]),
        " ".join(words[:12]) + " and nothing else of it",
        " ".join(words[:15]) + " far" * 60 + " " + " ".join(words[15:25]),
        bsd + " " + isc + " MIT License",
    ]
    rows = _scan(spark, texts)
    assert [rows[i].labels for i in range(5)] == ["bsd", "bsd", "", "", "bsd,isc,mit"]
    assert rows[0].score == 1 and 0.5 <= rows[1].score < 1 and rows[2].score == 0
    assert [rows[i].base_labels for i in range(5)] == ["", "", "", "", "mit"]


def test_edges(spark, edge, empty):
    assert licenses.scan(empty).count() == 0
    rows = licenses.scan(edge).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in rows) == sorted((str(r.doc_id), len(_words(r.text))) for r in edge.collect())
    assert sum(r.n_base for r in rows) == 1


def test_repeated_rows_are_rows(spark):
    rows = [(1, "MIT License")] * 3 + [(None, None)] * 2 + [(None, "")] + [(1, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted((str(r.doc_id), r.n_words, r.n_base, r.labels) for r in licenses.scan(docs).collect())
    assert found == [("1", 1, 0, "")] + [("1", 2, 1, "mit")] * 3 + [("None", 0, 0, "")] * 3


def test_words_are_verified_where_hashes_lie(spark, monkeypatch):
    """With hashes that take many words for the same, spans still need the template's words."""
    whole = licenses._grams
    monkeypatch.setattr(licenses, "_grams", lambda hashes, n, k: F.transform(whole(hashes, n, k), lambda h: h % 2))
    bsd = licenses.PASSAGES[3][0]
    texts = ["any words at all " * 40, "MIT License", bsd, "license mit " * 9]
    rows = _scan(spark, texts)
    assert [(rows[i].n_base, rows[i].labels) for i in range(4)] == [(0, ""), (1, "mit"), (0, "bsd"), (8, "mit")]


def test_many_templates_are_joined_by_a_shuffle(spark):
    passages = [(" ".join(f"w{i}x{j}" for j in range(40)), f"l{i}") for i in range(700)]
    docs = spark.createDataFrame([(1, "a " + passages[333][0]), (2, passages[5][0][:100]), (3, None)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs, passages=passages).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {1: ("l333", 1.0), 2: ("", 0.0), 3: ("", 0.0)}


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_words_are_put_together_only_where_a_hash_is_met(spark):
    """The join's one key is the hash and it has no condition, so a gram's text is no work of its own for every place; the
    texts are split in one projection, not again in a filter that Spark infers."""
    docs = spark.createDataFrame([(1, "MIT License")], "doc_id long, text string")
    plan = _plan(licenses.scan(docs))
    join = re.search(r"BroadcastHashJoin \[(.*?)\], \[(.*?)\], Inner, \w+, (.*)", plan)
    assert [re.sub(r"#\d+L?", "", join[i]) for i in (1, 2, 3)] == ["hash", "hash", "false"]
    explode = re.search(r"Generate posexplode\((.*)", plan)[1]
    assert "concat" not in explode and "transform" not in explode
    assert plan.count("split(") == 1


def _brute(words, templates):
    """n_base, first, last and labels of a text by comparing words at every place."""
    starts, labels = [], set()
    for k, needed, drift, t, label in templates:
        grams = {}
        for at in range(len(words) - k + 1):
            for position in range(len(t) - k + 1):
                if words[at:at + k] == t[position:position + k]:
                    grams.setdefault(at - position, set()).add(position)
        spans, last = [], None
        for diagonal in sorted(grams):
            if last is None or diagonal - last > drift:
                spans.append((diagonal, set()))
            spans[-1][1].update(grams[diagonal])
            last = diagonal
        good = [start for start, met in spans if len(met) / (len(t) - k + 1) >= needed]
        labels |= {label} if good else set()
        starts += good if k == licenses.PHRASE_GRAM else []
    return len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_places_of_short_and_long_grams(spark):
    """Texts of every small size, where the list of grams has no long, no short or few of either, by both joins."""
    import random

    draw = random.Random(5)
    phrases, passages = (("a b", "p"), ("b b", "q")), (("a b a a b", "five"), ("b a b b a b a a", "eight"))
    texts = [" ".join(draw.choice("ab") for _ in range(n)) for n in range(15) for _ in range(4)] + ["a b a a b", "x a b a a b", "x " * 300 + "a b a a b"]
    templates = [(2, 1.0, 0, t.split(), label) for t, label in phrases] + [(5, licenses.COVERAGE, licenses.DRIFT, t.split(), label) for t, label in passages]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            found = {r.doc_id: (r.n_base, r.first_word, r.last_word, r.labels) for r in licenses.scan(docs, phrases, passages).collect()}
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert found == {i: _brute(text.split(), templates) for i, text in enumerate(texts)}


def test_pieces_of_a_text_miss_no_place(spark, monkeypatch):
    """Grams at the seams of pieces of any size are found once, also where a text ends at a seam."""
    import random

    draw = random.Random(6)
    phrases, passages = (("a b", "p"), ("b b", "q")), (("a b a a b", "five"), ("b a b b a b a a", "eight"))
    texts = [" ".join(draw.choice("ab") for _ in range(n)) for n in range(18) for _ in range(2)]
    templates = [(2, 1.0, 0, t.split(), label) for t, label in phrases] + [(5, licenses.COVERAGE, licenses.DRIFT, t.split(), label) for t, label in passages]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(0, "")], "doc_id long, text string")
    expected = sorted([(i, len(t.split()), *map(str, _brute(t.split(), templates))) for i, t in enumerate(texts)] + [(0, 0, "0", "None", "None", "")])
    for size in (1, 4, 7):
        monkeypatch.setattr(licenses, "PIECE", size)
        rows = licenses.scan(docs, phrases, passages).collect()
        assert sorted((r.doc_id, r.n_words, str(r.n_base), str(r.first_word), str(r.last_word), r.labels) for r in rows) == expected


def test_what_goes_along_with_a_gram_is_short(spark):
    """A row that is exploded to its grams has the words of one piece, not of the text: without generated code it is
    copied for every gram."""
    docs = spark.createDataFrame([(1, "MIT License " * 5000)], "doc_id long, text string")
    plan = licenses.scan(docs)._jdf.queryExecution().optimizedPlan().toString()
    along = plan[plan.index("Generate posexplode("):]
    assert along.index("Generate explode(") < along.index("split(") and "slice(_w" in along
