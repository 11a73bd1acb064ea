import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import collocations as op


def brute(rows, least=100, top=2000, longest=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang][tuple(ws[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * a >= 100 * counts[p[i:j]]}
        scored = []
        for p, a in cand.items():
            if p not in gone:
                score, cut = min((1000 * a * n[lang] // (counts[p[:c]] * counts[p[c:]]), c) for c in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:cut]], counts[p[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, lang, "x", 1, 2) for i, (lang, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, phrase string, n int, rank int")
    got = op.collocations(df.repartition(3), **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def texts(n, seed=1):
    rng = np.random.default_rng(seed)
    words = np.array(["a", "b\x01", "bb", "Ab", "x-y", "der", "die", "und", "ä", "日本", "z\x00", "Z", "q'", "0"])
    p = np.array([8, 6, 5, 4, 3, 3, 2, 2, 2, 1, 1, 1, 1, 1.0])
    marks = np.array([" ", " ", " ", "  ", "\t", " ", ". ", ",", "\n", " ; "])
    out = []
    for _ in range(n):
        m = int(rng.integers(0, 40))
        ws, ms = rng.choice(words, m, p=p / p.sum()), rng.choice(marks, m)
        text = "".join(w + s for w, s in zip(ws, ms))
        if rng.random() < 0.3:
            text += " new york city hall of fame " * int(rng.integers(1, 4))
        out.append(([None, "en", "de", "und"][int(rng.integers(0, 4))], text))
    return out


EDGE = [("en", None), ("en", ""), (None, None), ("fr", " \t "), ("fr", "..,,"), ("", "one two"), ("en", "x" * 5000 + " y"),
        ("en", "hot pair " * 3000), ("en", "hot pair " * 3000), ("en", "\x0b\x0c a\x85b   c"), ("en", "..a.b,c d")]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # many chunks, slices, ranges and errors of the filter
        for name, value in (("CHUNK", 500), ("SLICE", 16), ("RANGE", 64), ("REQUESTS", 20), ("BATCH_BYTES", 200),
                            ("FILTER_BITS", 1 << 11), ("PART", 900), ("SHARD", 100), ("HASH_BITS", 12), ("BLOCKS", 2), ("KEY_BYTES", 3)):
            monkeypatch.setattr(op, name, value)
    rows = texts(300) + EDGE
    want = brute(rows, least=6)
    assert len(want) > 150 and run(spark, rows, least=6) == want


def test_top_and_lengths(spark):
    rows = texts(120, seed=5)
    assert run(spark, rows, least=3, top=7, longest=3) == brute(rows, 3, 7, 3)


def test_empty_and_nothing_frequent(spark):
    assert run(spark, []) == [] and run(spark, [("en", "a b c")]) == []


def test_edge_table(edge, spark):
    rows = [(r.lang, r.text) for r in edge.selectExpr("'en' lang", "text").collect()]
    got = op.collocations(edge.selectExpr("*", "'en' AS lang"), least=10)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least=10)


def sorted_rows(n, k, seed=0):
    rng = np.random.default_rng(seed)
    rows = np.unique(rng.integers(0, 9, size=(n, k)), axis=0)
    return rows, rng.integers(1, 50, size=len(rows))


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_automaton_holds_the_counts(k):
    rows, weights = sorted_rows(400, k)
    a = op.load(op.dump(op.build(rows, weights)))
    got, counts = op.paths(a)
    assert (got == rows).all() and (counts == weights).all()
    one, _ = op.paths(op.build(rows[:1], weights[:1]))
    assert (one == rows[:1]).all()


def test_equal_suffix_states_are_shared():
    rows = np.array([[a, b, c] for a in range(20) for b in range(5) for c in range(5)])
    a = op.build(rows, np.repeat(np.arange(1, 21), 25))  # the same continuations, other counts
    assert len(a["starts"]) - 2 == 3 and len(a["labels"]) == 30


@pytest.mark.parametrize("k", [1, 3])
def test_composition_is_the_intersection(k):
    (rows, weights), (asked, _) = sorted_rows(300, k), sorted_rows(200, k, seed=3)
    got, counts = op.compose(op.build(asked, np.zeros(len(asked), np.int64)), op.build(rows, weights))
    held = {tuple(r): w for r, w in zip(rows.tolist(), weights.tolist())}
    want = [(tuple(r), held[tuple(r)]) for r in asked.tolist() if tuple(r) in held]
    assert [(tuple(r), w) for r, w in zip(got.tolist(), counts.tolist())] == want


def test_scores_beyond_64_bits():
    """The query's score expression on counts whose products pass 64 bits."""
    from decimal import Decimal
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    a, n, l, r = 9 * 10**12, 8 * 10**13, 7 * 10**12 + 1, 3 * 10**12 + 7
    got = spark.sql(f"SELECT CAST((CAST(1000 AS DECIMAL(4,0)) * CAST({a}L AS DECIMAL(17,0)) * CAST({n}L AS DECIMAL(17,0))) "
                    f"div (CAST({l}L AS DECIMAL(19,0)) * CAST({r}L AS DECIMAL(19,0))) AS BIGINT) AS s").first().s
    assert got == int(Decimal(1000 * a * n) // Decimal(l * r)) == 1000 * a * n // (l * r)


def test_ranges_stay_even_when_shards_are_alike(spark, monkeypatch):
    """Shards of few phrases are one slice each and begin at the same phrase: no cut may need a slice's beginning."""
    for name, value in (("CHUNK", 500), ("SHARD", 100), ("RANGE", 500)):
        monkeypatch.setattr(op, name, value)
    united, entries = op.united, []

    def watched(slices, *rest):
        ranged = slices if "range" in slices.columns else op.overlapping(slices, rest[0])
        entries.extend(r.n for r in ranged.groupBy("range").agg(F.sum("n").alias("n")).collect())
        return united(slices, *rest)

    monkeypatch.setattr(op, "united", watched)
    rng = np.random.default_rng(2)
    rows = [("en", " ".join(rng.choice(["w%02d" % i for i in range(60)], 400))) for _ in range(150)]
    assert run(spark, rows, least=6, longest=2) == brute(rows, 6, 2000, 2)
    assert sum(entries) > 10_000 and max(entries) < 4 * op.RANGE


@pytest.mark.parametrize("k", [1, 2, 4])
def test_states_by_levels_are_those_one_by_one(k):
    rows, weights = sorted_rows(600, k, seed=8)
    weights = weights % 3 + 1  # many equal states
    a, b = op.by_levels(rows, weights), op.one_by_one(rows, weights)
    assert len(a["starts"]) == len(b["starts"]) and len(a["labels"]) == len(b["labels"]) and a["base"] == b["base"]
    for x in (a, b):
        got, counts = op.paths(x)
        assert (got == rows).all() and (counts == weights).all()


def test_batches_are_narrow_inside_only(spark):
    from newsflow.llm.store import narrow_batches
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = spark.range(0, 12, 1, 1).selectExpr("repeat('x', 1000000) AS s")
    sizes = lambda batches: (b.select([]).from_pydict({"n": [b.num_rows]}) for b in batches)
    before = spark.conf.get(name)
    with narrow_batches(spark, "3m"):
        assert max(r.n for r in rows.mapInArrow(sizes, "n long").collect()) <= 4
    assert spark.conf.get(name) == before
