import public_tokenizers
import sentencepiece

import corpus_pipeline
from panelkit.llm import mixing, ordered, quality, secrets
from panelkit.llm.text import table


def test_stages_one_by_one(spark, sf):
    """Each stage does to its own input what its operator says; operators have brute-force tests of their own."""
    docs = table(spark, sf, "documents")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, sf).cache()
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in quality.judge(docs).filter("kept").collect())
    distinct = stages["near_duplicates"](spark, good, sf).cache()
    assert sorted(r.doc_id for r in distinct.collect()) == sorted({r.class_id for r in ordered.deduplicated(good).collect()})
    masked = stages["secrets"](spark, distinct, sf).cache()
    before = {r.doc_id: r for r in distinct.collect()}
    for r in masked.collect():
        assert not secrets.base_spans(r.text) and (r.text == before[r.doc_id].text or "[SECRET]" in r.text)
    assert masked.count() == distinct.count()
    mixed = stages["mixing"](spark, masked, sf).cache()
    taken = {r.doc_id: r.taken for r in mixing.mix(masked).collect()}
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(taken.values())
    for df in (good, distinct, masked, mixed):
        assert df.schema == docs.schema
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    encoded = stages["encoding"](spark, mixed, sf).collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in encoded) == sorted((r.doc_id, tuple(library.encode(r.text))) for r in mixed.collect())
    assert all(library.decode(r.ids) == r.decoded and r.n_tokens == len(r.ids) for r in encoded)


def test_edges(spark, edge, empty, sf):
    for docs in (empty, edge):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, sf).count()
