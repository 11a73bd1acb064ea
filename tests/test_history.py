"""Indexed history: the same rows as ``drop_seen`` over everything, other parts unread."""

import os
import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

from newsflow.operators.dedup import drop_seen
from newsflow.operators.history import KeyHistory


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, day string").repartition(4)


def made(spark, scratch, rows, **kw):
    h = KeyHistory(spark, os.path.join(scratch, "history"), **kw)
    h.append(frame(spark, rows), "key", F.col("day"))
    return h


@pytest.mark.parametrize("bits_per_key", [0.001, 12])
def test_equal_to_drop_seen(spark, scratch, bits_per_key):
    rng = random.Random(4)
    rows = [(rng.choice([None, "", f"k{rng.randrange(4000)}", f"ü{rng.randrange(50)}"]), f"d{rng.randrange(20)}") for _ in range(6000)]
    h = made(spark, scratch, rows, bits_per_key=bits_per_key)
    new = frame(spark, [(k, "new") for k in [None, "", "ü1", "none", *(f"k{i}" for i in range(0, 6000, 7))]] * 2)
    got = sorted(map(str, h.drop_seen(new, "key").collect()))
    assert got == sorted(map(str, drop_seen(new, frame(spark, rows).filter("key IS NOT NULL"), ["key"]).collect()))
    assert h.keys().filter("key IS NULL").count() == 0


def test_filters_hold_every_key_and_few_others(spark, scratch):
    rows = [(f"k{i}", f"d{i % 10}") for i in range(40_000)]
    h = made(spark, scratch, rows)
    assert h.filters().select("part", "blocks").distinct().filter("blocks > 1").count() == 10  # many blocks a part
    for i in (0, 7, 19_999):
        assert f"d{i % 10}" in h.may_hold(frame(spark, [(f"k{i}", "x")]), "key")
    foreign = [h.may_hold(frame(spark, [(f"other{i}", "x")]), "key") for i in range(3)]
    assert sum(map(len, foreign)) <= 3  # about 1 of 100 per part


def test_only_parts_that_may_hold_a_key_are_read(spark, scratch):
    h = made(spark, scratch, [(f"{d}-{i}", d) for d in ("mon", "tue", "wed") for i in range(200)])
    new = frame(spark, [("tue-5", "x"), ("tue-6", "x"), ("new", "x")])
    seen = h.seen(new, "key")
    assert {r.part for r in seen.collect()} == {"tue"}
    for df in (seen, h.drop_seen(new, "key")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*part#\d+ = tue\)", plan), plan
    assert [r.key for r in h.drop_seen(new, "key").collect()] == ["new"]


def test_repeated_and_lost_writes(spark, scratch):
    rows = [("a", "d1"), ("b", "d2")]
    h = made(spark, scratch, rows)
    h.append(frame(spark, rows), "key", F.col("day"))  # a repeated pass
    assert h.keys().count() == 2
    h.append(frame(spark, [("c", "d1")]), "key", F.col("day"))  # a part is replaced
    assert sorted(r.key for r in h.keys().collect()) == ["b", "c"]
    shutil.rmtree(os.path.join(scratch, "history", "filters", "part=d2"))  # lost between the two writes
    assert h.may_hold(frame(spark, [("zzz", "x")]), "key") == ["d2"]
    assert h.drop_seen(frame(spark, [("b", "x")]), "key").count() == 0


def test_empty_history(spark, scratch):
    h = KeyHistory(spark, os.path.join(scratch, "none"))
    assert h.may_hold(frame(spark, [("a", "x")]), "key") == [] and h.drop_seen(frame(spark, [("a", "x")]), "key").count() == 1


def test_keys_whose_hashes_sum_past_64_bits(spark, scratch):
    keys = ["k370237", "k585904", "k758001"]  # such keys ended the job
    h = made(spark, scratch, [(k, "d1") for k in keys])
    assert h.may_hold(frame(spark, [("k1192841", "x"), (keys[0], "x")]), "key") == ["d1"]
    assert [r.key for r in h.drop_seen(frame(spark, [(k, "x") for k in [*keys, "k1192841"]]), "key").collect()] == ["k1192841"]
