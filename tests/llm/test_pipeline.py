import hashlib

import corpus_pipeline
from docloom.llm import mixing, minmax, secrets, toxicity
from docloom.llm.texts import table
from docloom.workspace import stage


def test_stages_follow_each_other(spark, data):
    docs = table(spark, data, "documents")
    labels = table(spark, data, "labels")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "secret_scan", "source_mix", "bpe_encode"]
    at, kept = docs, []
    for _, function in corpus_pipeline.STAGES:
        at = stage(function(spark, at, data), "test")
        kept.append(at)
    assert all(k.columns == docs.columns for k in kept[:-1])
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).filter("predicted = 1").collect()}
    first = {r.doc_id for r in kept[0].collect()}
    assert first == {r.doc_id for r in docs.collect()} - toxic
    groups = {r.doc_id for r in minmax.near_duplicates(kept[0]).filter("kept").collect()}
    assert {r.doc_id for r in kept[1].collect()} == groups
    scanned = kept[2].collect()
    assert {r.doc_id for r in scanned} == groups
    assert all(not secrets.base_spans(r.text or "") for r in scanned)
    before = {r.doc_id: r.text for r in kept[1].collect()}
    assert all(r.text == before[r.doc_id] or secrets.MASK in r.text for r in scanned)
    taken = {
        r.doc_id: r.taken // r.size for r in mixing.mixed(kept[2], whole=True).collect() if r.size and r.taken
    }
    copies = {r.doc_id: r["count"] for r in kept[3].groupBy("doc_id").count().collect()}
    assert copies == taken
    texts = {r.doc_id: r.text for r in kept[3].collect()}
    for r in kept[4].collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert kept[4].count() == kept[3].count()


def test_run_is_the_chain_of_stages(spark, data):
    found = corpus_pipeline.run(spark, data)
    assert {"doc_id", "n_tokens", "ids_sha256"} <= set(found.columns)
    assert found.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_rows(spark, clashing, none, data):
    for docs in (clashing, none):
        at = docs
        for _, function in corpus_pipeline.STAGES[:-1]:
            at = stage(function(spark, at, data), "odd")
            assert at.columns == docs.columns
        last = corpus_pipeline.STAGES[-1][1](spark, at, data)
        assert last.count() == at.count()
