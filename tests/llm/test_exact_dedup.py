import re
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from newsflow.llm.exact_dedup import exact_dedup, groups, keep_one
from tests.llm.conftest import TEXTS


def brute(rows):
    """Counter of the rows of the contract."""
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    members = defaultdict(list)
    for k, n in enumerate(norm):
        members[n].append(k)
    out = Counter()
    for n, ks in members.items():
        rank = lambda k: (-len(rows[k][1] or ""), rows[k][0] is None, rows[k][0] or 0)
        best = min(ks, key=rank)
        for k in ks:
            out[(rows[k][0], rows[best][0], len(ks), k == best, sha256(n.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("salts", [1, 64])
def test_against_brute_force(edge, salts):
    got = exact_dedup(edge, salts=salts)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want, found = brute(TEXTS), Counter(tuple(r) for r in got.collect())
    # of rows that repeat id and text any one is kept
    assert found == want


def test_empty(empty):
    assert exact_dedup(empty).count() == 0 and keep_one(empty).count() == 0


def test_colliding_digests_do_not_merge_texts(edge):
    """A digest of one value for every text: the contents still tell the groups apart."""
    g = groups(edge, digest=lambda norm: F.lit("same"))
    want = Counter((i, k, n, kept) for (i, k, n, kept, _), c in brute(TEXTS).items() for _ in range(c))
    assert Counter((r.id, r.keep_id, r.group_size, r.kept) for r in g.collect()) == want


def test_keep_one_keeps_whole_rows(edge):
    kept = keep_one(edge)
    assert kept.columns == edge.columns
    want = Counter({(i, n): 1 for (i, _, n, k, d) in brute(TEXTS) if k for n in [d]})
    got = Counter((r.doc_id, sha256(re.sub(r"[\x20\x09-\x0D]", "", r.text or "").encode()).hexdigest())
                  for r in kept.collect())
    assert got == want and kept.first()["key"] == "key?"


def test_hot_text_is_one_row_per_task(spark):
    rows = spark.range(0, 3000, 1, 6).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot text")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = exact_dedup(rows)
    assert got.filter("keep_id = 0").count() == 1000 and got.filter("kept").count() == 2001
