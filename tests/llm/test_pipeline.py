import re
from collections import Counter

import corpus_pipeline
from newsflow.llm.queries import table
from newsflow.llm.store import stored
from tests.llm.test_ngram_join import brute as near
from tests.llm.test_secret_scan import brute as secrets

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs, seen = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), f"test_{name}")
        rows, were = docs.collect(), before.collect()
        seen[name] = len(rows)
        if name != "packing":
            assert docs.columns == COLUMNS and docs.schema == before.schema
        if name == "exact_dedup":
            norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
            assert Counter(norm(r.text) for r in rows) == Counter({norm(r.text) for r in were})
        if name == "ngram_join":
            classes = near([(r.doc_id, r.text) for r in were])
            assert {r.doc_id for r in rows} == {c for _, c, _ in classes}
        if name == "secret_scan":
            assert [r.doc_id for r in sorted(rows)] == [r.doc_id for r in sorted(were)]
            assert all(secrets(r.text) == "" and r.n_chars == len(r.text) for r in rows)
            clean = {r.doc_id: r.text for r in were if secrets(r.text) == ""}
            assert all(r.text == clean[r.doc_id] for r in rows if r.doc_id in clean)
        if name == "packing":
            assert {r.doc_id for r in rows} == {r.doc_id for r in were}
    assert seen["toxicity"] >= 0.8 * table(spark, SF, "documents").count()


def test_registered(spark):
    import __spark_entry__
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {
        q if q == "pipeline" else q.split("_")[0] + "_" for q in __spark_entry__.queries()}
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_on_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test_empty")
        assert docs.count() == 0
