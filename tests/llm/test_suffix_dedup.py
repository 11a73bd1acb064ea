import random
from collections import Counter

import numpy as np
import pytest

from newsflow.llm import suffix_dedup as op
from tests.llm.conftest import TEXTS

LENGTH = 50


def brute(rows):
    """``(id, n_bytes, n_removed, n_spans, kept)`` of every row."""
    last = float("inf")
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - LENGTH + 1):
            w = raw[p:p + LENGTH]
            first[w] = min(first.get(w, last), last if i is None else i)
    out = Counter()
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - LENGTH + 1):
            if first[raw[p:p + LENGTH]] < (last if i is None else i):
                gone[p:p + LENGTH] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(bool(g) and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[(i, len(raw), int(gone.sum()), spans, kept)] += 1
    return out


def run(df):
    return Counter((r[0], r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in op.suffix_dedup(df).collect())


def repeats(seed=0, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(12, 60))) for _ in range(5)]
    rows = []
    for i in rng.sample(range(1000), n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(3)]
        text = parts[0] + rng.choice(passages) + parts[1] + rng.choice(passages)[rng.randint(0, 9):] + parts[2]
        rows.append((i, text))
    return rows + [(2000, rows[0][1]), (2001, "z" * 300), (2002, "z" * 120), (1, "z" * 49), (0, "z" * 50)]


@pytest.mark.parametrize("piece", [1 << 14, 64])
def test_against_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(op, "PIECE", piece)
    rows = repeats()
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_edge_rows(spark, edge, empty):
    short = [(i, t if len(t or "") < 5000 else t[:3000] + t[-1:]) for i, t in TEXTS]
    assert run(spark.createDataFrame(short, "doc_id long, text string")) == brute(short)
    assert op.suffix_dedup(edge).count() == len(TEXTS) and op.suffix_dedup(empty).count() == 0


def test_every_run_keeps_a_string_it_shares():
    """Winnowing keeps one string inside each run, and the same one wherever the run stands."""
    rng = np.random.default_rng(0)
    run_ = rng.integers(97, 101, 80, dtype=np.uint8)
    kept = []
    for _ in range(5):
        data = np.concatenate([rng.integers(97, 101, rng.integers(0, 90), dtype=np.uint8), run_,
                               rng.integers(97, 101, 30, dtype=np.uint8)])
        at = data.tobytes().find(run_.tobytes())
        h, least = op.gram_hashes(data), op.winnowed(data)
        assert least.tolist() == [min(h[p:p + LENGTH - op.GRAM + 1].tolist()) for p in range(len(least))]
        kept.append(least[at:at + len(run_) - LENGTH + 1].tolist())
    assert all(k == kept[0] for k in kept)


def test_names_keep_the_order_of_triples():
    rng = np.random.default_rng(3)
    a, b, c = rng.integers(0, 4, (3, 500))
    names = op.names_of(a, b, c)
    triples = list(zip(a.tolist(), b.tolist(), c.tolist()))
    rank = {t: i for i, t in enumerate(sorted(set(triples)))}
    assert names.tolist() == [rank[t] for t in triples]


@pytest.mark.parametrize("size", [1, 300, 4000])
def test_any_number_of_parts_and_buckets(spark, monkeypatch, size):
    for name in ("PART_BYTES", "BUCKET_BYTES", "SORTED_BYTES"):
        monkeypatch.setattr(op, name, size)
    monkeypatch.setattr(op, "MOST_FILES", 20)
    rows = repeats(seed=5, n=30)
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_texts_are_not_shuffled_again(spark):
    texts, files = op.bucketed(op._keyed(spark.createDataFrame(repeats(), "doc_id long, text string"), "doc_id", "text"))
    plan = op.pieces(texts, files)._jdf.queryExecution().executedPlan().toString()
    own = [line for line in plan.splitlines() if "Exchange" in line]
    assert "FlatMapCoGroupsInArrow" in plan and all("text" not in line for line in own), plan


def test_keys_order_as_pairs():
    rng = np.random.default_rng(1)
    for high in (3, 1 << 40, 1 << 62):
        a, b = rng.integers(0, high, (2, 300))
        a[:100] = a[0]
        key = op.joined_keys(a, b)
        assert np.lexsort((b, a)).tolist() == np.argsort(key, kind="stable").tolist()
    assert op.ranked(np.array([], dtype=np.int64)).tolist() == [] and op.ranked(np.array([7, 3, 7])).tolist() == [1, 0, 1]


def test_runs_are_ruled_out_and_covered_as_by_comparing():
    rng = random.Random(6)
    base = bytes(rng.choice(b"ab") for _ in range(150))
    runs = [base[i:i + rng.randint(50, 90)] for i in range(60)] + [bytes(rng.choice(b"cdefgh") for _ in range(70))
                                                                    for _ in range(20)]
    ords = np.array(rng.sample(range(100), len(runs)))
    strings = {}
    for run_, o in zip(runs, ords.tolist()):
        for p in range(len(run_) - LENGTH + 1):
            strings.setdefault(run_[p:p + LENGTH], []).append(o)
    own = lambda r: [r[p:p + LENGTH] for p in range(len(r) - LENGTH + 1)]
    assert op.repeating(runs).tolist() == [i for i, r in enumerate(runs) if any(len(strings[w]) > 1 for w in own(r))]
    gone, start = op.covered_starts(runs, ords)
    for r, o, first in zip(runs, ords.tolist(), start.tolist()):
        assert gone[first:first + len(r)].tolist() == [min(strings[w]) < o for w in own(r)] + [False] * (LENGTH - 1)


def test_string_that_many_share_is_no_parts_work(spark, monkeypatch):
    monkeypatch.setattr(op, "MOST_RUNS", 50, raising=False)
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage, other = noise(70), noise(90)
    rows = [(i, noise(rng.randint(0, 40)) + passage + noise(rng.randint(0, 40))) for i in rng.sample(range(1000), 300)]
    rows += [(1000 + i, other[i:] + noise(60) + other) for i in range(9)] + [(2000, "z" * 300), (2001, "z" * 120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    parts = op.pieces(*op.bucketed(op._keyed(df, "doc_id", "text")))
    counts = Counter()
    for r in op.dealt(parts)[0].collect():
        data, at = bytes(r.data), 0
        for n in np.frombuffer(r["size"], np.int32).tolist():
            counts[int(op.winnowed(np.frombuffer(data[at:at + n], np.uint8))[0])] += 1
            at += n
    assert max(counts.values()) <= 50 + 2  # before: 300 runs of the passage in one part
    assert run(df) == brute(rows)
