"""Rounding and dates against Python, at the edges of their fast paths."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from newsflow.functions import compact_to_iso
from newsflow.functions.tone import round_exact


def test_rounding_of_large_values(spark):
    rng = random.Random(8)
    values = [rng.choice([-1, 1]) * rng.uniform(lo, hi) for lo, hi in ((1e11, 1e12), (1e12, 4.6e12), (4e12, 9.1e12), (9e12, 1e16))
              for _ in range(1500)] + [2.0 ** 53 / 1000, 4.5e12 + 0.0005, 1e12 + 0.0625, 1e300, float("inf")]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_exact(F.col("v")).alias("r")).collect()
    assert [(r.v, r.r) for r in got if r.r != (round(r.v, 3) if r.v != float("inf") else r.v)] == []


def iso(text):
    try:
        return datetime.strptime(text[:14], "%Y%m%d%H%M%S").isoformat()
    except ValueError:
        return None


def test_dates_of_any_digits(spark):
    rng = random.Random(2)
    texts = ["20260517120000", "20261317120000", "20260230120000", "2026051712000", "20260517120000999", "00000000000000",
             "2026051712000x", "20260517 20000", "19991231235959"]
    texts += ["".join(rng.choice("0123456789") for _ in range(rng.choice([8, 10, 12, 13, 14, 15]))) for _ in range(800)]
    texts += [f"20{rng.randrange(100):02d}{rng.randrange(1, 14):02d}{rng.randrange(1, 33):02d}{rng.randrange(25):02d}"
              f"{rng.randrange(61):02d}{rng.randrange(61):02d}" for _ in range(800)]
    texts = [t for t in texts if t[:4] != "0000" or iso(t) is None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", compact_to_iso("t").alias("i")).collect()
    assert [(r.t, r.i, iso(r.t)) for r in got if r.i != iso(r.t)] == []
