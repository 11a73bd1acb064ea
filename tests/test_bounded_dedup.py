"""Dedup with a memory bounded by count, against a plain model over random batches."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from newsflow.streaming.dedup import dedup_bounded, forgotten_keys, use_rocksdb

SCHEMA = "url string, at long, note string"


def model(batches, bucket_of, cap, keep, buckets):
    """Rows that pass, per micro-batch, and forgotten keys per bucket."""
    most, left = -(-cap // buckets), keep // buckets
    sent, forgotten, out = {}, {}, []
    for rows in batches:
        by = {}
        for r in rows:
            by.setdefault(bucket_of[r[0]], []).append(r)
        passed = []
        for b, rs in by.items():
            keys = sent.setdefault(b, [])
            rs.sort(key=lambda r: ((r[1] is None, r[1] or 0), tuple(str(v) for v in r)))
            for r in rs:
                if r[0] not in keys:
                    keys.append(r[0])
                    passed.append(r)
            if len(keys) > most:
                forgotten[b] = forgotten.get(b, 0) + len(keys) - left
                sent[b] = keys[len(keys) - left:] if left else []
        out.append(sorted(passed, key=str))
    return out, forgotten


@pytest.fixture()
def run(spark, scratch):
    def go(batches, **kw):
        old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        use_rocksdb(spark)
        src, ckpt, got = os.path.join(scratch, "src"), os.path.join(scratch, "ckpt"), []
        os.makedirs(src)
        for i, rows in enumerate(batches):
            path = os.path.join(src, f"b{i:03d}.json")
            with open(path, "w") as fh:
                fh.writelines(json.dumps(dict(zip(("url", "at", "note"), r))) + "\n" for r in rows)
            os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))

        def start():
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
            q = dedup_bounded(stream, "url", ["at"], **kw).writeStream.foreachBatch(
                lambda df, i: got.append(sorted((tuple(r) for r in df.collect()), key=str))).option(
                "checkpointLocation", ckpt).trigger(availableNow=True).start()
            q.awaitTermination()

        start()
        before = len(got)
        start()  # a restart from the checkpoint sends nothing again
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
        assert len(got) == before
        return got, {r.bucket: r.forgotten for r in forgotten_keys(spark, ckpt).collect()}
    return go


@pytest.mark.parametrize("cap,keep,buckets", [(12, 6, 3), (5, 0, 1), (10_000, 100, 4)])
def test_against_the_model(spark, run, cap, keep, buckets):
    rng = random.Random(cap)
    urls = [None, "", *(f"http://h{i}/" for i in range(30))]
    batches = [[(rng.choice(urls), rng.choice([None, 1, 2, 3]), rng.choice(["a", None, "b"])) for _ in range(rng.randrange(1, 25))]
               for _ in range(5)]
    ids = spark.createDataFrame([(u,) for u in urls], "url string")
    bucket_of = {r.url: r.b for r in ids.select("url", F.pmod(F.xxhash64("url"), F.lit(buckets)).alias("b")).collect()}
    want, forgotten = model(batches, bucket_of, cap, keep, buckets)
    got, counted = run(batches, cap=cap, keep=keep, buckets=buckets)
    assert [sorted(b, key=str) for b in got] == want and counted == forgotten
    assert bool(forgotten) == (cap < 10_000)
