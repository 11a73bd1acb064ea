import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import hard_negatives as op


def brute(rows, every=10, k_pos=5, k_neg=10):
    use = [(i, lab, [int(x) * 256 if math.isinf(x * 256) else math.floor(x * 256) for x in v]) for i, v, lab in rows
           if i is not None and lab is not None and v is not None
           and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, lab, v) in enumerate(use):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, m) for b, (j, m, w) in enumerate(use)
                        if b != a and len(w) == len(v))
        for p, j, m in [s for s in scored if s[2] == lab][:k_pos]:
            neg = [(n, q) for n, q, m in scored if m != lab and 30 * -p <= 100 * -n <= 90 * -p][:k_neg]
            fit = lambda s: -s if -(1 << 63) <= -s < 1 << 63 else None
            out += [(i, j, r + 1, q, fit(p), fit(n)) for r, (n, q) in enumerate(neg)]
    return sorted(out, key=str)


def run(spark, rows, every=10, **kw):
    df = spark.createDataFrame([(i, v, lab, "x", 1, 2) for i, v, lab in rows],
                               "vec_id long, embedding array<double>, label int, id string, anchor int, score int")
    got = op.hard_negatives(df.repartition(3), "vec_id", "embedding", F.col("label"), every, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def vectors(n, dim, seed=0, scale=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(3, dim)) * 0.3 + 0.3
    return [(i, [float(x) * scale for x in centre[i % 3] + rng.normal(size=dim) * 0.2], int(i % 4)) for i in range(n)]


def test_random_ties_and_bad_rows(spark):
    rows = vectors(300, 8)
    rows += [(1000 + i, rows[3][1], i % 2) for i in range(40)]  # one vector many times: ties by id
    rows += [(2000, None, 1), (2010, rows[0][1], None), (None, rows[0][1], 1), (2020, [1.0, None], 1),
             (2030, [float("nan")] * 8, 1), (2040, [float("inf")] * 8, 1), (2050, [], 1), (2051, [], 1), (2052, [], 2),
             (2060, [0.0] * 8, 1), (2070, [1.0, 2.0], 1), (2071, [1.0, 2.0], 1), (2072, [0.4, 0.7], 3),
             (10, rows[5][1], 2)]  # a repeated id is another row
    want = brute(rows)
    assert run(spark, rows) == want and len(want) > 500


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ROWS", 16)
    rows = vectors(200, 6, seed=4)
    assert run(spark, rows, strips=5) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, rows[:1]) == []


@pytest.mark.parametrize("scale", [1e-300, 1e-3, 1e3, 1e9, 1e150, 1e306])
def test_any_finite_scale_is_exact(spark, scale):
    rows = [(i, [x if i % 3 else x * scale for x in v], lab) for i, v, lab in vectors(60, 4, seed=2)]
    assert run(spark, rows) == brute(rows)


def test_fields_do_not_touch():
    """Largest and smallest components in neighbouring fields."""
    rng = np.random.default_rng(1)
    for high in (1, 100, 4000, 1 << 20, 1 << 30):
        a = rng.integers(-high, high + 1, size=(7, 64)).astype(float)
        c = rng.choice([-high, 0, high], size=(33, 64)).astype(float)
        want = np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in c] for r in a])
        assert (op.scores(a, c) == want).all()
        assert (op._long_scores(a, c, op.field_bits(a, c)) == want).all()
    assert op.WORD_BITS // op.field_bits(np.full((1, 64), 160.0), np.full((1, 64), 160.0)) == 2


def test_query_columns_and_relabelling(spark, tmp_path):
    from newsflow.llm.queries import QUERIES
    rows = vectors(400, 8, seed=6)
    path = str(tmp_path)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    kept = [(i, [float(np.float32(x)) for x in v], (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows]
    got = QUERIES["op12_hard_negatives"](spark, path)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(kept, every=100)


def test_anchors_repeated_for_strips_do_not_pass_the_driver(spark, monkeypatch):
    """The anchors are small for Spark's estimate; repeated for every strip they are not, so they may not be broadcast."""
    plans, stored = {}, op.stored
    monkeypatch.setattr(op, "stored", lambda df, name: (plans.update(
        {name: df._jdf.queryExecution().executedPlan().toString()}), stored(df, name))[1])
    rows = vectors(400, 8, seed=3)
    assert run(spark, rows, strips=300) == brute(rows)
    assert "Broadcast" not in plans["positives"]


@pytest.mark.parametrize("scale", [1.0, 1e306])
def test_many_cells_give_the_same(spark, monkeypatch, scale):
    for name, value in (("BLOCK_ROWS", 32), ("CELL_BYTES", 400), ("STEP", 3)):
        monkeypatch.setattr(op, name, value)
    rows = [(i, [x if i % 5 else x * scale for x in v], lab) for i, v, lab in vectors(300, 6, seed=7)]
    rows += [(1000 + i, rows[3][1], i % 2) for i in range(60)] + [(2000, [], 1), (2010, [], 1), (2011, [], 2)]
    want = brute(rows, every=2)
    assert len(want) > 500 and run(spark, rows, every=2) == want


@pytest.mark.parametrize("top", [100, 30_000, 1 << 40, 1e300])
def test_integers_are_read_as_written(top):
    whole = op.integers(np.array([[top, -top, 0.3], [-0.1, 7.0, top / 3]]))
    got = op.unpacked_integers(op.packed_integers(whole), 2, 3)
    assert got.dtype == whole.dtype and (got == whole).all()


def test_first_columns_of_a_block_rule_out_others():
    rng = np.random.default_rng(5)
    score, fits = rng.integers(-9, 9, size=(40, 640)), rng.random((40, 640)) < 0.5
    fits[3] = False
    fits[4, 2:] = False
    for values in (score, score.astype(object)):
        best = op.Best(40, 5)
        for at in range(0, 640, 320):
            best.take(values[:, at:at + 320], fits[:, at:at + 320], np.arange(at, at + 320))
        want = [(i, j) for i in range(40)
                for j in sorted(np.flatnonzero(fits[i]).tolist(), key=lambda j: (-score[i, j], j))[:5]]
        assert list(zip(best.row.tolist(), best.ids.tolist())) == want
        assert [score[i, j] for i, j in want] == best.score.tolist()
