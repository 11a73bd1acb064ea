"""Mergeable document counts: the refitted model is the one that ``IDF.fit`` gives."""

import os

from pyspark.sql import functions as F

from newsflow.operators.idf_state import IdfState
from newsflow.operators.text import build_ml_pipeline

DOCS = [("b1", "economic growth slows again"), ("b1", "growth of trade and trade"), ("b2", "trade talks resume"), ("b2", None),
        ("b2", ""), ("b3", "weather warning issued, growth expected"), (None, "in no batch")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "batch string, text string").repartition(3)


def same(a, b):
    assert a.numDocs == b.numDocs and list(a.docFreq) == list(b.docFreq)
    assert max(abs(x - y) for x, y in zip(a.idf.toArray(), b.idf.toArray())) < 1e-12 and max(a.idf.toArray()) > 0


def test_merged_batches_equal_a_fit_on_the_union(spark, scratch):
    state = IdfState(spark, os.path.join(scratch, "state"))
    assert state.model() is None
    rows = [r for r in DOCS if r[0]]
    for b in ("b1", "b2", "b3", "b2"):  # one batch again
        state.add(frame(spark, [r for r in rows if r[0] == b]), F.col("batch"))
    state.add(frame(spark, DOCS[-1:]), F.col("batch"))
    fit = lambda rs: build_ml_pipeline().fit(frame(spark, [(b, t or "") for b, t in rs]))
    whole = fit(rows)
    same(state.model(), whole.stages[-1])
    part = state.states().filter("batch <> 'b3'")
    same(state.model(part), fit([r for r in rows if r[0] != "b3"]).stages[-1])
    # a pipeline fitted on one batch, refitted: the features are those of the fit on all
    old = fit([r for r in rows if r[0] == "b1"])
    docs = frame(spark, rows).fillna("")
    got, want = (sorted(str(r.features) for r in m.transform(docs).select("features").collect()) for m in (state.refit(old), whole))
    assert got == want
