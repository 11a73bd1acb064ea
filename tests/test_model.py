"""ML-1..ML-9: pipeline vs SQL twins, save/load, corrupt version, empty batch."""

import os

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from newsflow.operators.model import ModelStore, featurize
from newsflow.operators.text import (
    build_ml_pipeline, default_stop_words, remove_stop_words, tfidf, tokenize,
)

DOCS = [(1, "Economy and inflation: the ECON_TAX rises, café's prices"), (2, "THE economy grows; Taxi fares rise"),
        (3, "ab cd ef"), (4, "")]


def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


def test_stop_words_match_spark(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert list(default_stop_words()) == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_twin_equals_ml(spark):
    model = build_ml_pipeline().fit(docs(spark))
    ml = {r.doc_id: (r.tokens, r.filtered_tokens) for r in model.transform(docs(spark)).collect()}
    twin = docs(spark).select("doc_id", tokenize("text").alias("t"), remove_stop_words(tokenize("text")).alias("f"))
    for r in twin.collect():
        assert (r.t, r.f) == ml[r.doc_id]
    assert "caf" in ml[1][0] and "econ_tax" in ml[1][0] and "the" not in ml[2][1]


def test_idf_twin_equals_ml_weights(spark):
    d = docs(spark)
    model = build_ml_pipeline().fit(d)
    idf = model.stages[-1].idf.toArray()
    from pyspark.ml.feature import HashingTF
    htf = HashingTF(numFeatures=10_000)
    twin = tfidf(d.select("doc_id", remove_stop_words(tokenize("text")).alias("t")), "doc_id", "t").collect()
    for r in twin:
        assert abs(r.idf - idf[htf.indexOf(r.term)]) < 1e-12  # no collisions in this tiny vocabulary


def test_store_save_load_and_corrupt(spark, scratch):
    root = os.path.join(scratch, "models")
    store = ModelStore(spark, root)
    assert store.load_or_train(docs(spark).limit(0)) is None  # empty batch: no fit
    m1 = store.load_or_train(docs(spark))
    v1 = store.current_version()
    again = ModelStore(spark, root).load()
    a = featurize(m1, docs(spark)).select("doc_id", vector_to_array("features").alias("f")).orderBy("doc_id").collect()
    b = featurize(again, docs(spark)).select("doc_id", vector_to_array("features").alias("f")).orderBy("doc_id").collect()
    assert a == b
    # corrupt the live version: a new store retrains into a new version and keeps the old files
    import shutil
    shutil.rmtree(os.path.join(root, v1, "stages"))
    fresh = ModelStore(spark, root)
    assert fresh.load_or_train(docs(spark)) is not None
    assert fresh.current_version() != v1 and os.path.isdir(os.path.join(root, v1))


def versions(root):
    return sorted(d for d in os.listdir(root) if d.startswith("v"))


def test_two_jobs_that_train_at_once_leave_one_version(spark, scratch):
    root = os.path.join(scratch, "models")
    slow, fast = ModelStore(spark, root), ModelStore(spark, root)

    class Meanwhile:
        """A pipeline during whose fit another job publishes its model."""
        def fit(self, training):
            model = build_ml_pipeline().fit(training)
            assert fast.load_or_train(docs(spark)) is not None
            return model

    loaded = slow.load_or_train(docs(spark), Meanwhile())
    assert versions(root) == [fast.current_version()]  # the loser dropped its own and loaded the winner's
    assert loaded.uid == fast.load().uid and slow.load() is loaded
    assert [f for f in os.listdir(root)
            if f.startswith((".CURRENT.", ".after-nothing.")) and not f.endswith(".crc")] == []


def test_threads_that_train_at_once_agree(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    root = os.path.join(scratch, "models")
    with ThreadPoolExecutor(3) as pool:
        models = list(pool.map(lambda _: ModelStore(spark, root).load_or_train(docs(spark)), range(3)))
    live = ModelStore(spark, root)
    assert live.current_version() in versions(root)
    assert all(m is not None for m in models)


def test_pointer_is_moved_for_a_winner_that_ended(spark, scratch):
    root = os.path.join(scratch, "models")
    gone, store = ModelStore(spark, root), ModelStore(spark, root)
    won = gone._write(build_ml_pipeline().fit(docs(spark)))
    assert gone._put(".after-nothing", won, replace=False) and not gone._put(".after-nothing", "other", replace=False)
    assert store.current_version() is None and store.load_or_train(docs(spark)) is not None
    assert store.current_version() == won and versions(root) == [won]


def test_featurize_on_stream(spark, scratch):
    model = build_ml_pipeline().fit(docs(spark))
    src = os.path.join(scratch, "txt")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("economy taxi economy\n")
    stream = spark.readStream.format("text").load(src).withColumnRenamed("value", "text")
    q = (featurize(model, stream).select(F.size("filtered_tokens").alias("n")).writeStream.format("memory")
         .queryName("feat").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("select n from feat").collect()[0].n == 3
