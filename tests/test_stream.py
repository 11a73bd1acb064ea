"""Stream job over a file source: equals the batch twin, replay and restart, watermark dedup."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from newsflow.sinks.parquet import read_output
from newsflow.streaming.dedup import dedup_within_watermark
from newsflow.streaming.job import consume_records, parse_wire, run_key, start_stream, stream_source


def rec(rid, url, ts, tone, batch):
    return {"record_id": rid, "event_time": ts, "source": "s", "url": url, "themes": "a|b", "locations": "l",
            "persons": "p", "organizations": "o", "all_names": "n", "tone_score": tone,
            "ingested_at": "x", "batch_url": f"b{batch}", "is_first_batch": batch == 0}


BATCHES = [
    [rec("1", "u1", "2026-01-01T00:00:00", -3.0, 0), rec("2", "u1", "2026-01-01T00:00:00", 1.0, 0),
     rec("3", "u2", None, 5.0, 0), rec("4", None, "2026-01-01T01:00:00", 0.0, 0)],
    [rec("5", "u1", "2026-01-02T00:00:00", 2.5, 1), rec("6", "u3", "2026-01-02T00:00:00", 2.0, 1)],
    [],
    ["{not json"],
]


def write_batches(folder):
    os.makedirs(folder, exist_ok=True)
    for i, b in enumerate(BATCHES):
        with open(os.path.join(folder, f"part-{i:03d}.json"), "w") as fh:
            for r in b:
                fh.write((r if isinstance(r, str) else json.dumps(r)) + "\n")
        os.utime(os.path.join(folder, f"part-{i:03d}.json"), (1_700_000_000 + i, 1_700_000_000 + i))


def test_stream_equals_batch_and_replay(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, n) for n in ("src", "out", "ckpt"))
    write_batches(src)
    from newsflow.streaming.job import BatchWriter
    rejected = os.path.join(scratch, "rejected")
    writer = BatchWriter(out, run_key(ckpt), rejected_path=rejected)
    q = (stream_source(spark, "files", {"maxFilesPerTrigger": 1}, path=src).writeStream.foreachBatch(writer)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    assert [(s["rows"], s["malformed"], s["rejected"]) for s in writer.stats] == [(4, 0, 2), (2, 0, 0), (0, 0, 0), (1, 1, 1)]
    assert all(s["sent"] + s["rejected"] == s["rows"] for s in writer.stats)
    gone = read_output(spark, rejected, run_key(ckpt)).collect()
    assert sorted((r.batch_id, r.reason, r.record_id) for r in gone if r.record_id) == [(0, "no_time", "3"), (0, "no_url", "4")]
    assert [(r.batch_id, r.url) for r in gone if r.reason == "malformed"] == [(3, None)]
    got = read_output(spark, out, run_key(ckpt)).drop("run")
    rows = sorted((r.record_id, r.sentiment_label, r.batch_id) for r in got.collect())
    assert rows == [("1", "negative", 0), ("5", "positive", 1), ("6", "neutral", 1)]
    # batch twin on the same records gives the same rows
    wire = spark.read.text(src).select(F.col("value").cast("binary").alias("value"))
    parsed = parse_wire(wire).withColumn("batch_id", F.substring("batch_url", 2, 1).cast("int"))
    twin = sorted((r.record_id, r.sentiment_label, r.batch_id) for r in consume_records(parsed).collect())
    assert twin == rows
    # restart from the checkpoint: nothing new, output unchanged
    q = start_stream(stream_source(spark, "files", {"maxFilesPerTrigger": 1}, path=src), out, ckpt,
                     trigger={"availableNow": True})
    q.awaitTermination()
    assert read_output(spark, out, run_key(ckpt)).count() == 3


def test_rejects_are_replaced_by_a_replay_and_counted_in_the_same_job(spark, scratch):
    from newsflow.streaming.job import BatchWriter
    src, out, rejected = (os.path.join(scratch, n) for n in ("src", "out", "rejected"))
    write_batches(src)
    messages = spark.read.text(src).select(F.col("value").cast("binary").alias("value"))
    writer = BatchWriter(out, "r", rejected_path=rejected)
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for attempt in range(2):
        spark.sparkContext.setJobGroup(f"rejects-{attempt}", "")
        writer(messages, 5)
        jobs.append(len(tracker.getJobIdsForGroup(f"rejects-{attempt}")))
    spark.sparkContext._jsc.clearJobGroup()
    want = {"batch_id": 5, "rows": 7, "sent": 4, "rejected": 3, "malformed": 1}
    assert list(writer.stats) == [want, want]
    assert read_output(spark, rejected, "r").count() == 3
    writer.rejected_path = None  # the rejects are not kept: the same counters, and no more jobs
    spark.sparkContext.setJobGroup("rejects-none", "")
    writer(messages, 6)
    spark.sparkContext._jsc.clearJobGroup()
    assert writer.stats[-1] == {**want, "batch_id": 6}
    assert len(tracker.getJobIdsForGroup("rejects-none")) == jobs[1]


def test_bounded_records(spark, scratch, capsys):
    import pytest

    from newsflow.__main__ import main
    from newsflow.streaming.job import bounded_records
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    write_batches(src)
    assert bounded_records(spark, "files", path=src).filter("url = 'u1'").count() == 3
    main(["readback", out, "--files", src, "--preview", "3"])
    assert spark.read.parquet(out).count() == 7 and "record_id" in capsys.readouterr().out
    with pytest.raises(Exception, match="(?i)kafka"):
        bounded_records(spark, "kafka", {"kafka.bootstrap.servers": "broker:9092", "subscribe": "raw"})
    with pytest.raises(ValueError):
        bounded_records(spark, "socket")


def test_watermark_dedup_across_files(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, n) for n in ("src", "out", "ckpt"))
    write_batches(src)
    recs = parse_wire(stream_source(spark, "files", {"maxFilesPerTrigger": 1}, path=src))
    recs = recs.withColumn("event_time", F.to_timestamp("event_time")).dropna(subset=["url", "event_time"])
    q = (dedup_within_watermark(recs, ["url"], "event_time", "7 days").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    urls = sorted(r.url for r in spark.read.parquet(out).collect())
    assert urls == ["u1", "u3"]  # u1 of the second file is a cross-batch duplicate


def test_stream_trains_on_first_batch_then_reuses(spark, scratch):
    from newsflow.operators.model import ModelStore
    src, out, ckpt, models = (os.path.join(scratch, n) for n in ("src", "out", "ckpt", "models"))
    write_batches(src)
    store = ModelStore(spark, models)
    q = start_stream(stream_source(spark, "files", {"maxFilesPerTrigger": 1}, path=src), out, ckpt,
                     trigger={"availableNow": True}, model_store=store)
    q.awaitTermination()
    versions = [d for d in os.listdir(models) if d.startswith("v")]
    assert len(versions) == 1 and store.current_version() == versions[0]  # trained once, reused after
    assert read_output(spark, out, run_key(ckpt)).count() == 3


def test_kafka_source_is_wired_but_needs_the_connector(spark):
    import pytest
    with pytest.raises(Exception, match="(?i)kafka"):
        stream_source(spark, "kafka", {"kafka.bootstrap.servers": "broker:9092", "subscribe": "raw"})
    with pytest.raises(ValueError):
        stream_source(spark, "socket")


def test_a_large_batch_of_wire_messages_is_written_by_several_tasks(spark, monkeypatch):
    from newsflow import queries
    made, _stream_input = queries.q_batch_lineage_records, queries._stream_input
    monkeypatch.setattr(queries, "q_batch_lineage_records", lambda *a: made(*a).repartition(4))  # from several tasks
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "8k")  # a day of the smallest tables is more
    try:
        split, whole = (_stream_input(spark, "/root/testdata/sf0.001", whole=w) for w in (False, True))
    finally:
        spark.conf.set(conf, before)
    files = {p: spark.read.text(p).select(F.input_file_name().alias("f"), "batch_id").distinct().groupBy("batch_id")
             .count().collect() for p in (split, whole)}
    assert max(r["count"] for r in files[split]) > 1 and {r["count"] for r in files[whole]} == {1}
    lines = [spark.read.text(p).select("batch_id", "value") for p in (split, whole)]
    assert lines[0].exceptAll(lines[1]).count() == 0 == lines[1].exceptAll(lines[0]).count()
