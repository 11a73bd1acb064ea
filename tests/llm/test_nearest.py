import numpy as np
import pytest

from newsflow.llm import nearest as op


def brute(rows, every, k):
    usable = [(i, np.array(v, dtype=np.float64)) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, x) in enumerate(usable):
        if i % every == 0:
            with np.errstate(all="ignore"):
                scores = [(float((x * y).sum()), j) for b, (j, y) in enumerate(usable) if b != a and len(y) == len(x)]
            scores.sort(key=lambda s: (s[0] != s[0], -s[0] if s[0] == s[0] else 0, s[1]))
            out += [(i, rank + 1, j, s) for rank, (s, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


def run(spark, rows, every=5, k=4, kind="float"):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                               f"vec_id long, embedding array<{kind}>, id string, block int")
    return sorted(((r.query_id, r.rank, r.id, r.score) for r in op.nearest(df.repartition(3), "vec_id", "embedding",
                                                                            every, k).collect()), key=str)


def test_random_with_ties_and_bad_rows(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]  # one vector many times: ties by id
    rows += [(1000, None), (1005, []), (1010, [0.0] * 8), (1015, [1.0, None] + [0.0] * 6), (None, rows[0][1]),
             (1020, [float("nan")] * 8), (1025, [float("inf")] * 8), (1030, [1.0, 2.0]), (1031, [3.0, -2.0])]
    assert run(spark, rows) == brute(rows, 5, 4)


def test_small_blocks_and_few_candidates(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i * 5, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(3)]
    assert run(spark, rows, k=20) == brute(rows, 5, 20)
    assert run(spark, [], k=20) == []


def test_repeated_ids_are_separate_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.0]), (1, [0.25, 0.0])]
    assert run(spark, rows) == brute(rows, 5, 4)


def test_tile_prunes_but_keeps_the_best():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(50, 16)), rng.normal(size=(900, 16))
    which, ids, score = op.tile_best(x, np.arange(50), y, np.arange(1000, 1900), np.arange(900), 10)
    for q in range(50):
        s = (x[q] * y).sum(axis=1)
        assert ids[which == q].tolist() == np.lexsort((np.arange(900), -s))[:10].tolist()


@pytest.mark.parametrize("scale", [1e-30, 1e30])
def test_extreme_scales(spark, scale):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x * scale)) for x in rng.normal(size=4)]) for i in range(60)]
    assert run(spark, rows) == brute(rows, 5, 4)


@pytest.mark.parametrize("low,high", [(1, 1e200), (1, 1e154), (1e-200, 1e-160), (1e-300, 1e300), (1e150, 1e160), (1e307, 1e307)])
def test_mixed_scales_of_doubles(spark, low, high):
    """Finite doubles whose squares or products overflow or vanish."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(x * (high if i % 2 else low)) for x in rng.normal(size=4)]) for i in range(60)]
    got, want = run(spark, rows, kind="double"), brute(rows, 5, 4)
    assert str(got) == str(want)  # NaN is written alike
