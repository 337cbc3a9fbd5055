from panelkit.llm import rollups


def _totals(spark, store):
    return sorted(map(tuple, rollups.totals(spark, store).collect()), key=str)


def test_batches(spark, edge, empty, tmp_path):
    store = str(tmp_path / "store")
    counts = rollups.counted(edge, "blanks-1")
    rollups.commit(store, 1, rollups.inserts(counts))
    first = _totals(spark, store)
    expected = {}
    for r in edge.collect():
        n, tokens = expected.get((r.source, r.lang), (0, 0))
        expected[r.source, r.lang] = n + 1, tokens + len((r.text or "").split())
    assert first == sorted(((s, g, "blanks-1", n, t) for (s, g), (n, t) in expected.items()), key=str)
    rollups.commit(store, 2, rollups.inserts(rollups.counted(empty, "blanks-1")))
    assert _totals(spark, store) == first
    rollups.commit(store, 3, rollups.revisions(counts, rollups.counted(edge, "runs-2")))
    third = _totals(spark, store)
    rollups.commit(store, 3, rollups.revisions(counts, rollups.counted(edge, "runs-2")))
    rollups.commit(store, 1, rollups.inserts(counts))
    assert _totals(spark, store) == third and {r[2] for r in third} == {"runs-2"}
    rollups.compact(spark, store, str(tmp_path / "small"), through=2)
    assert _totals(spark, str(tmp_path / "small")) == third
    rollups.commit(str(tmp_path / "small"), 4, rollups.deletes(rollups.counted(edge, "runs-2")))
    assert _totals(spark, str(tmp_path / "small")) == []


def test_null_counts(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, None, "t", None), (1, None, None, "t", 4)], "sign int, source string, lang string, tokenizer string, n_tokens long")
    rollups.commit(str(tmp_path / "s"), 1, rows)
    assert _totals(spark, str(tmp_path / "s")) == [(None, None, "t", 2, 4)]


def test_folded_batches_are_not_counted_again(spark, edge, tmp_path):
    store, small = str(tmp_path / "store"), str(tmp_path / "small")
    counts = rollups.counted(edge, "blanks-1")
    for batch in (1, 2, 3):
        rollups.commit(store, batch, rollups.inserts(counts))
    rollups.compact(spark, store, small, through=2)
    expected = _totals(spark, store)
    for batch in (1, 2, 3):
        rollups.commit(small, batch, rollups.inserts(counts))
        assert _totals(spark, small) == expected
    rollups.compact(spark, small, str(tmp_path / "smaller"), through=3)
    for batch in (1, 3):
        rollups.commit(str(tmp_path / "smaller"), batch, rollups.inserts(counts))
    assert _totals(spark, str(tmp_path / "smaller")) == expected


def test_a_commit_cut_short_leaves_the_totals(spark, edge, tmp_path, monkeypatch):
    """Without its manifest a table isn't there, neither a new batch nor a batch's new self."""
    store = str(tmp_path / "store")
    counts = rollups.counted(edge, "blanks-1")
    rollups.commit(store, 1, rollups.inserts(counts))
    before = _totals(spark, store)

    class Lost(Exception):
        pass

    def lost(*_):
        raise Lost

    whole = rollups.Log.publish
    monkeypatch.setattr(rollups.Log, "publish", lost)
    for batch in (1, 2):
        try:
            rollups.commit(store, batch, rollups.deletes(counts))
        except Lost:
            pass
        assert _totals(spark, store) == before
    monkeypatch.setattr(rollups.Log, "publish", whole)
    rollups.commit(store, 2, rollups.deletes(counts))
    assert _totals(spark, store) == []


def test_an_empty_store(spark, tmp_path):
    assert _totals(spark, str(tmp_path / "none")) == []
