import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from panelkit.llm import pieces, registry

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.read_model(PATH))


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="ab eilnorst \n\t▁=-.é日😀́"), st.text(alphabet="a ▁=", max_size=80), st.text(alphabet="ab \n\t.é")))
def test_encodes_and_decodes_like_the_library(text):
    encoder_, library_ = _pair()
    assert list(encoder_.encode(text)) == library_.encode(text)
    assert encoder_.decode(library_.encode(text)) == library_.decode(library_.encode(text))


_PAIR = []


def _pair():
    if not _PAIR:
        _PAIR.extend([pieces.Encoder(pieces.read_model(PATH)), sentencepiece.SentencePieceProcessor(model_file=PATH)])
    return _PAIR


def test_decodes_any_tokens_like_the_library(encoder, library):
    rng = random.Random(3)
    for _ in range(5000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(262) for _ in range(rng.randint(0, 8))]
        assert encoder.decode(ids) == library.decode(ids), ids


def test_long_words_and_full_memory(encoder, library, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS", 50)
    monkeypatch.setattr(pieces, "PAIRS", 50)
    text = "ab" * 20_000 + " " + "=" * 5000 + " the" * 1000 + " ".join(str(i) for i in range(500))
    assert list(encoder.encode(text)) == library.encode(text)


def test_documents(spark, edge, empty, library, sf):
    codec = pieces.Codec(spark, PATH)
    rows = edge.select("text", codec.encode("text").alias("ids")).withColumn("back", codec.decode("ids")).collect()
    for r in rows:
        assert r.ids == library.encode(r.text or "") and r.back == library.decode(r.ids)
    assert empty.select(codec.encode("text").alias("ids")).count() == 0
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in registry.op4_pieces(spark, sf).collect():
        ids = library.encode(texts[r.doc_id] or "")
        assert tuple(r)[1:] == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))


def test_out_of_range_and_null_ids(spark, encoder):
    codec = pieces.Codec(spark, PATH)
    rows = spark.createDataFrame([(1, [1618, None, 305]), (2, None), (3, []), (4, [1618])], "i int, ids array<int>")
    found = {r.i: r.t for r in rows.select("i", codec.decode("ids").alias("t")).collect()}
    assert found == {1: encoder.decode([1618, 0, 305]), 2: "", 3: "", 4: encoder.decode([1618])}
    assert encoder.decode([-1, 40_000, 5]) == encoder.decode([0, 0, 5])


def test_a_batch_is_coded_in_small_parts(encoder, library):
    """Beyond its own texts, a batch takes memory for a part of them only."""
    texts = [None, "", *(f"the river {i} runs under old stone bridges, é日😀\n" * 400 for i in range(400)), "bridge " * 400_000, None, "end"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    before, most, rows = pa.total_allocated_bytes(), 0, []
    for part in pieces._coded(encoder, iter([batch])):
        most = max(most, pa.total_allocated_bytes() - before, part.nbytes)
        assert part.schema.names == ["doc_id", "ids", "decoded"]
        rows += [(r["doc_id"], len(r["ids"]), hash(tuple(r["ids"])), r["decoded"]) for r in part.to_pylist()]
        del part
    assert batch.nbytes > 10_000_000 and most < 8_000_000
    expected = [(n, library.encode(t or "")) for n, t in enumerate(texts)]
    assert rows == [(n, len(ids), hash(tuple(ids)), library.decode(ids)) for n, ids in expected]
    assert sum(p.num_rows for p in pieces._coded(encoder, iter([batch.slice(0, 0)]))) == 0


def test_tables(spark, edge, library):
    found = pieces.Codec(spark, PATH).coded(edge, "doc_id", "lang").collect()
    texts = edge.select("doc_id", "lang", "text").collect()
    expected = [(r.doc_id, r.lang, library.encode(r.text or "")) for r in texts]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(((*r, library.decode(r[2])) for r in expected), key=key)
