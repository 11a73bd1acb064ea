"""SNK-1, SNK-3, SNK-4, SNK-5, STR-5."""

import json
import os

from pyspark.sql import functions as F

from newsflow.sinks.parquet import read_output, roundtrip, write_batch, write_batches, write_partitioned
from newsflow.sinks.publish import batch_status, to_messages


def test_messages_explicit_nulls_and_key(spark):
    df = spark.createDataFrame([("http://a", "r1", None, 1.5)], "url string, record_id string, themes string, tone double")
    row = to_messages(df).collect()[0]
    assert bytes(row.key) == b"http://a"
    assert json.loads(bytes(row.value)) == {"url": "http://a", "record_id": "r1", "themes": None, "tone": 1.5}
    assert to_messages(df, key_col=None).collect()[0].key is None


def test_batch_status(spark):
    recs = spark.createDataFrame([("b1", 1), ("b1", 1), ("b2", 2)], "batch_url string, batch_id int")
    got = {r.batch_url: r for r in batch_status(recs, timestamp=F.lit("t")).collect()}
    assert got["b1"].record_count == 2 and got["b1"].is_first and not got["b2"].is_first
    assert got["b2"].event == "batch_published"


def out_df(spark, batch, labels):
    return spark.createDataFrame([(f"r{batch}{i}", lab, batch) for i, lab in enumerate(labels)],
                                 "record_id string, sentiment_label string, batch_id int")


def test_write_batch_replay_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "out")
    write_batch(out_df(spark, 1, ["neutral", "positive"]), path, 1, "rA")
    write_batch(out_df(spark, 1, ["neutral", "positive"]), path, 1, "rA")  # replay
    write_batch(out_df(spark, 2, ["negative"]), path, 2, "rA")
    assert read_output(spark, path, "rA").count() == 3
    write_batch(out_df(spark, 2, [])[["record_id", "sentiment_label", "batch_id"]].limit(0), path, 2, "rA")
    assert read_output(spark, path, "rA").count() == 2  # a batch with no valid row clears its directory


def test_write_batches_dynamic_overwrite(spark, scratch):
    path = os.path.join(scratch, "many")
    df = out_df(spark, 1, ["neutral", "positive"]).unionByName(out_df(spark, 2, ["negative"]))
    write_batches(df, path, "rB")
    write_batches(df, path, "rB")
    assert read_output(spark, path, "rB").count() == 3


def test_partitioned_and_roundtrip(spark, scratch):
    df = out_df(spark, 1, ["neutral", "positive", "neutral"])
    write_partitioned(df, os.path.join(scratch, "p"), mode="overwrite", files_per_partition=1)
    parts = sorted(d for d in os.listdir(os.path.join(scratch, "p")) if d.startswith("sentiment_label="))
    assert parts == ["sentiment_label=neutral", "sentiment_label=positive"]
    assert roundtrip(spark, df, "t").count() == 3


def test_compact_keeps_rows_and_reduces_files(spark, scratch):
    path = os.path.join(scratch, "c")
    for b in range(3):
        write_batch(out_df(spark, 1, ["neutral"] * 4).repartition(4), path, 1, "rC") if b == 0 else None
    write_batch(out_df(spark, 2, ["neutral", "positive"] * 3).repartition(3), path, 2, "rC")
    write_batch(out_df(spark, 5, ["negative"]), path, 5, "other")
    before = read_output(spark, path).count()
    from newsflow.sinks.parquet import compact
    compact(spark, path, "rC")
    assert read_output(spark, path).count() == before
    d = os.path.join(path, "run=rC", "batch_id=2", "sentiment_label=neutral")
    assert len([f for f in os.listdir(d) if f.endswith(".parquet")]) == 1
    assert read_output(spark, path, "other").count() == 1
