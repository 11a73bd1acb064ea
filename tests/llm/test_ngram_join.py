import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np

from newsflow.llm import ngram_join as op
from newsflow.llm.components import components
from tests.llm.conftest import TEXTS


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(rows, threshold=Fraction(4, 5)):
    """``(id, class id, links)`` of every row, by all pairs."""
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    index = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            index[g].append(k)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, s in enumerate(sets):
        for e, n in Counter(e for g in s for e in index[g] if e != k).items():
            if n >= threshold * (len(s) + len(sets[e]) - n):
                links[k] += 1
                root[max(find(k), find(e))] = min(find(k), find(e))
    members = defaultdict(list)
    for k in range(len(rows)):
        members[find(k)].append(rows[k][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    return Counter((rows[k][0], least[find(k)], links[k]) for k in range(len(rows)))


def run(df):
    return Counter(tuple(r) for r in op.near_duplicates(df).collect())


def near_copies(seed=0, groups=12, size=9, noise=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(6, 220))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 45))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append(" ".join(w))
    shared = " ".join(rng.choice(vocabulary) for _ in range(30))  # a passage that does not make two texts alike
    rows += [shared + " " + " ".join(rng.choice(vocabulary) for _ in range(90)) for _ in range(noise)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_against_all_pairs(spark):
    rows = near_copies()
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_large_group_in_several_tiles(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE_TOKENS", 2000)
    monkeypatch.setattr(op, "SMALL", 4)
    rows = near_copies(seed=1, groups=2, size=60, noise=5)
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def members_of(spark, groups, size, tokens=100):
    """Groups of near copies as ``verified`` takes them: in each, all members are linked with each other."""
    rows = [(b"root%d" % g, b"%d of %d" % (i, g), 1, tokens, [g * 10**6 + k for k in range(tokens - 1)] + [-1 - i - g * 10**6])
            for g in range(groups) for i in range(size)]
    return spark.createDataFrame(rows, "root binary, cls binary, copies long, size int, tokens array<bigint>")


def test_tile_with_an_empty_block(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE_TOKENS", 100)  # two blocks for two members: often both are in one
    links = op.verified(members_of(spark, 10, 2)).groupBy("cls").sum("links").collect()
    assert len(links) == 20 and {r[1] for r in links} == {1}


def test_tiles_are_bounded_in_members(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE_MEMBERS", 50, raising=False)
    monkeypatch.setattr(op, "STRIP_PAIRS", 700, raising=False)
    members = members_of(spark, 1, 300, tokens=20)  # 6,000 tokens: one block by tokens alone
    assert op.tiled(members).groupBy("pack", "i", "j").count().agg({"count": "max"}).first()[0] < 2 * 50 + 60
    links = op.verified(members).groupBy("cls").sum("links").collect()
    assert len(links) == 300 and {r[1] for r in links} == {299}


def test_edge_rows(edge, empty):
    assert run(edge) == brute(TEXTS)
    assert run(empty) == Counter() and op.keep_one(empty).count() == 0
    kept = op.keep_one(edge)
    assert kept.columns == edge.columns
    # One id a class; rows without words stay.
    alive = {(i, c) for i, c, _ in brute(TEXTS)}
    assert {r.doc_id for r in kept.collect()} == {i for i, c in alive if i == c}


def test_runs_reach_the_recall():
    n = op.runs_for(0.9999, 0.8, 4)
    assert 1 - (1 - 0.8 ** 4) ** n >= 0.9999 > 1 - (1 - 0.8 ** 4) ** (n - 1)


def test_floor_is_part_of_the_recall(spark):
    rng = np.random.default_rng(1)
    n = op.runs_for() * op.DEPTH
    a = rng.integers(-1 << 31, 1 << 31, n, dtype=np.int64)
    rows = []
    # A pair at 0.8 has 43 or 44 of 72 equal samples with a probability of 1.5e-4, above the target's 1e-4.
    for equal, name in ((43, b"43"), (30, b"30")):
        shift = a + len(rows)
        rows += [(name + b"a", shift.tolist()), (name + b"b", np.where(np.arange(n) < equal, shift, shift + 1000).tolist())]
    rows = [(c, [(v + 2 ** 31) % 2 ** 32 - 2 ** 31 for v in sig]) for c, sig in rows]
    links = op.candidate_links(spark.createDataFrame(rows, "cls binary, sig array<int>"), op.runs_for()).collect()
    assert {bytes(x) for r in links for x in r} == {b"43a", b"43b"}
    hit = np.random.default_rng(2).binomial(n, 0.8, 2_000_000)
    assert (hit < op.least_equal(op.runs_for())).mean() + (1 - 0.8 ** 4) ** op.runs_for() < 1.2e-4


def test_samples_agree_as_often_as_sets_do():
    rng = np.random.default_rng(0)
    pool = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    a, b = pool[:2000], np.concatenate([pool[:1600], pool[2000:2400]])  # similarity 2/3
    tokens, offsets = np.concatenate([np.sort(a), np.sort(b)]), np.array([0, 2000, 4000])
    sig = op.samples(tokens, offsets, 2000)
    assert abs((sig[0] == sig[1]).mean() - 2 / 3) < 0.05


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    edges += [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(250)]
    df = spark.createDataFrame(edges, "a long, b long")
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components(df, "test_components").collect()}
    assert got == {x: find(x) for x in root}
