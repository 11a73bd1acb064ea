from zlib import crc32

import pytest

from newsflow.llm import toxicity as op
from newsflow.llm.queries import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def fitted(spark):
    return op.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_held_out_rows(spark, fitted):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = op.score(docs, fitted).join(labels, "doc_id").select("doc_id", "score", "predicted", "toxic").collect()
    held = [r for r in scored if crc32(str(r.doc_id).encode()) % 5 == 0]
    bad, good = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert auc > 0.85 and sum(s >= 0.5 for s in good) <= 0.05 * len(good)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)


def test_labels_of_held_out_rows_do_not_matter(spark, fitted):
    from pyspark.sql import functions as F
    labels = table(spark, SF, "labels")
    turned = labels.withColumn("toxic", F.when(op.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert op.fit(table(spark, SF, "documents"), turned) == fitted


def test_weights_are_sparse(fitted):
    assert 1 < len(fitted) < 20_000


def test_edge_rows(spark, edge, empty, fitted):
    out = op.score(edge, fitted)
    assert out.count() == edge.count() and all(0 <= r.score <= 1 for r in out.select("score").collect())
    blank = {r.score for r in out.filter("text is null or text = ''").collect()}
    assert len(blank) == 1  # the intercept alone
    assert op.score(empty, fitted).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1), (4, 1), (4, 0), (4, 1)], "doc_id long, toxic int")
    assert op.score(edge, op.fit(edge, labels)).count() == edge.count()
    assert op.fit(edge, labels.limit(0)) == {} and op.fit(empty, labels) == {}
    assert {(r.score, r.predicted) for r in op.score(edge, {}).collect()} == {(0.5, 0)}


ODD = [None, "", "  ", "A", "a a a", "abc ABC abcdef", "One, two! three?? one two", "Don't stop", "é È ß 日本 x1 2y",
       "word " * 400 + "end", "(((tab\tnew\nline)))"]


def plain_features(text):
    """Coordinates of one text, feature by feature."""
    import re
    mask, most = (1 << op.BITS) - 1, 1 << 64
    first, second = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
    words = [w for w in re.sub(r"[^\W_]+|.", lambda m: m[0] if m[0][0].isalnum() else " ", (text or "").lower(),
                               flags=re.S).split(" ") if w]
    crc, out = lambda t: crc32(t.encode()), set()
    for w in words:
        out |= {crc(w) * first % most >> 40 & mask}
        out |= {crc(w[:n] + "*") * first % most >> 40 & mask for n in (4, 5, 6) if len(w) >= n}
    for gap in (1, 2):
        for a, b in zip(words, words[gap:]):
            mixed = (crc(a) * first + gap) % most ^ crc(b) * second % most
            out.add(mixed * first % most >> 40 & mask)
    return sorted(out - {0})


def test_features_against_a_plain_loop(spark):
    import numpy as np
    import pyarrow as pa
    texts = [t or "" for t in ODD] + [r.text or "" for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    which, at = op.Features().pairs(pa.array(texts))
    bounds = np.searchsorted(which, np.arange(len(texts) + 1)).tolist()
    for i, t in enumerate(texts):
        assert at[bounds[i]:bounds[i + 1]].tolist() == plain_features(t), t[:80]
    wanted = np.zeros(1 << op.BITS, bool)
    wanted[at[::3]] = True
    some = op.Features().pairs(pa.array(texts), wanted)
    keep = wanted[at]
    assert some[0].tolist() == which[keep].tolist() and some[1].tolist() == at[keep].tolist()


def test_update_rule_against_a_plain_loop():
    import random
    from math import exp, sqrt

    import numpy as np
    rng = random.Random(3)
    examples = [(np.array([0, *sorted(rng.sample(range(1, 60), rng.randint(0, 8)))], np.int32), float(rng.random() < 0.3))
                for _ in range(300)]
    z, n = {}, {}

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        rate = (op.BETA + sqrt(ni)) / op.ALPHA
        if i == 0:
            return -zi / rate
        return 0.0 if abs(zi) <= op.L1 else -(zi - (op.L1 if zi > 0 else -op.L1)) / (rate + op.L2)

    for _ in range(op.EPOCHS):
        for at, label in examples:
            w = {i: weight(i) for i in at.tolist()}
            g = 1 / (1 + exp(-sum(w.values()))) - label
            for i, wi in w.items():
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (sqrt(n[i]) - sqrt(before)) / op.ALPHA * wi
    got_z, got_n = op.train(examples)
    assert set(np.flatnonzero(got_n).tolist()) == set(n)
    assert all(abs(got_z[i] - z[i]) < 1e-9 and abs(got_n[i] - n[i]) < 1e-9 for i in n)
    w = op.proximal(got_z, got_n)
    assert all(abs(w[i] - weight(i)) < 1e-9 for i in n if i) and 0 < np.count_nonzero(w) < len(n)


def test_scores_against_a_plain_sum(spark, fitted):
    from math import exp
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, "tied words", "tied words", "long text " * 200_000])],
                                 "doc_id long, text string")
    got = {r.doc_id: (r.score, r.predicted) for r in op.score(rows, fitted).collect()}
    for i, t in [(r.doc_id, r.text) for r in rows.collect()]:
        total = fitted[0] + sum(fitted.get(c, 0.0) for c in plain_features(t if t is None or len(t) < 10_000 else "long text " * 3))
        want = 1 / (1 + exp(-total))
        assert abs(got[i][0] - want) < 1e-9 and got[i][1] == (got[i][0] >= 0.5)
    assert got[len(ODD)] == got[len(ODD) + 1]
