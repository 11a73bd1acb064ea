"""Registered queries: one per operator of SURVEY section 2, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole driver tables (through the builders in
``newsflow.sources.tables``) and returns the operator's full result; none caps,
samples or filters ids. ``newsflow.oracle`` holds the DuckDB SQL twin of each.
Timestamps that face DuckDB are ``timestamp_ntz`` (DuckDB timestamps carry no zone).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions import (
    compact_to_iso, iso_to_ts, list_comma, list_pipe, parse_compact_ts, polarity_label,
    polarity_score, tone_label, tone_score, url_host,
)
from newsflow.functions import clean_list as clean_list_col
from newsflow.functions import build_text as build_text_col
from newsflow.operators import dedup, quality, text
from newsflow.plans import clean as clean_plan
from newsflow.plans import legacy, normalize
from newsflow.schemas import (
    GKG_COLUMNS, LEGACY_PRODUCER_COLUMNS, LIST_COLUMNS, TEXT_COLUMNS, WIRE_SCHEMA,
)
from newsflow.sources import manifest as manifest_src
from newsflow.sources.tables import gkg_view, landed_lines, manifest_lines, quoted_lines, read_table

GKG_NAMES = list(GKG_COLUMNS.values())
DAY_MS = 86_400_000


def _view(spark, sf_dir) -> DataFrame:
    return gkg_view(spark, sf_dir)


def _gkg(spark, sf_dir) -> DataFrame:
    """The raw 10-column GKG projection of the view."""
    return _view(spark, sf_dir).select(*GKG_NAMES)


def _ingested_at(batch_id_col="batch_id"):
    """Publish time of a daily archive: the start of the next day, ISO text."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.col(batch_id_col) + 1)
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00"))


# --- scans and positional access -----------------------------------------------------------

def q_gkg_project(spark, sf_dir):
    """SRC-2: positional select and rename of the 10 used fields of 27-field lines."""
    lines = landed_lines(spark, sf_dir)
    return normalize.project_lines(lines, keep=("line_no",))


def q_ragged_fields(spark, sf_dir):
    """SRC-3: fields of lines of 10 to 30 fields; a field past the end reads as ``''``."""
    lines = landed_lines(spark, sf_dir, ragged=True)
    return normalize.project_lines(lines, missing="", keep=("line_no",))


def q_wide_scan_skip_bad(spark, sf_dir):
    """SRC-5 + PRJ-18: per archive, the first line's width rules (legacy column map)."""
    lines = landed_lines(spark, sf_dir, ragged=True)
    return legacy.wide_scan_skip_bad(lines, LEGACY_PRODUCER_COLUMNS, "batch_url", "line_no")


def q_wide_scan_quoted(spark, sf_dir):
    """SRC-5 + PRJ-18 with the legacy reader's quotes and missing values."""
    return legacy.wide_scan_quoted(quoted_lines(spark, sf_dir), LEGACY_PRODUCER_COLUMNS, "batch_url", "line_no")


def q_manifest_parse(spark, sf_dir):
    """SRC-7 + FLT-6: latest URL per kind in each manifest."""
    return manifest_src.latest_urls(manifest_lines(spark, sf_dir), "manifest", "line_no")


def q_manifest_first(spark, sf_dir):
    """SRC-8: first line naming a ``gkg.csv`` archive in each manifest, last token."""
    return manifest_src.first_gkg_url(manifest_lines(spark, sf_dir), "manifest", "line_no")


# --- column functions ----------------------------------------------------------------------

def q_parse_compact_ts(spark, sf_dir):
    return _view(spark, sf_dir).select("record_id", parse_compact_ts("raw_date").alias("event_time"))


def q_compact_to_iso(spark, sf_dir):
    return _view(spark, sf_dir).select("record_id", compact_to_iso("raw_date").alias("event_time"))


def q_iso_to_ts(spark, sf_dir):
    iso = _view(spark, sf_dir).select("record_id", compact_to_iso("raw_date").alias("iso"))
    return iso.select("record_id", "iso", iso_to_ts("iso").alias("event_time"))


def q_tone_score(spark, sf_dir):
    return _view(spark, sf_dir).select("record_id", tone_score("tone_raw").alias("tone_score"))


def q_tone_label(spark, sf_dir):
    scored = _view(spark, sf_dir).select("record_id", tone_score("tone_raw").alias("tone_score"))
    return scored.withColumn("sentiment_label", tone_label("tone_score"))


def q_polarity(spark, sf_dir):
    v = _view(spark, sf_dir)
    raw = F.coalesce(F.col("tone_raw"), F.lit(""))
    return v.select("record_id", polarity_score(raw).alias("sentiment_score"),
                    polarity_label(raw).alias("sentiment_label"))


def q_clean_list(spark, sf_dir):
    return _view(spark, sf_dir).select("record_id", *[clean_list_col(c).alias(c) for c in LIST_COLUMNS])


def q_list_pipe(spark, sf_dir):
    return _view(spark, sf_dir).select("record_id", *[list_pipe(c).alias(c) for c in LIST_COLUMNS])


def q_list_comma(spark, sf_dir):
    v = _view(spark, sf_dir)
    return v.select("record_id", *[list_comma(F.coalesce(F.col(c), F.lit(""))).alias(c)
                                   for c in ["themes", "locations", "persons", "organizations"]])


def q_build_text(spark, sf_dir):
    v = _view(spark, sf_dir).select("record_id", *[clean_list_col(c).alias(c) for c in TEXT_COLUMNS])
    return v.select("record_id", build_text_col(*TEXT_COLUMNS).alias("text"))


def q_url_host(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select("page_id", "url", url_host("url").alias("host"))


def q_json_flatten(spark, sf_dir):
    """PRJ-12: bytes -> JSON struct -> columns (``events.props`` as the message value)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", F.col("props").cast("binary").alias("value"))
    parsed = ev.select("event_id", F.from_json(F.col("value").cast("string"), "k INT").alias("d"))
    return parsed.select("event_id", "d.*")


# --- filters, dedup, jobs -------------------------------------------------------------------

def q_required_fields(spark, sf_dir):
    parsed = clean_plan.parse_fields(_gkg(spark, sf_dir))
    return quality.require_not_null(parsed, ["url", "event_time"])


def q_required_nonempty(spark, sf_dir):
    v = _view(spark, sf_dir).select("record_id", "url", "raw_date")
    return quality.require_nonempty(v, ["url", "raw_date"])


def q_reject_counts(spark, sf_dir):
    fields = normalize.project_lines(landed_lines(spark, sf_dir), keep=("batch_url",))
    return quality.reject_counts(fields, normalize.producer_valid(), by=["batch_url"])


def _dedup_input(spark, sf_dir):
    v = _view(spark, sf_dir).select("record_id", "url", "raw_date", "source", "tone_raw")
    v = v.withColumn("event_time", parse_compact_ts("raw_date"))
    return quality.require_not_null(v, ["url"])


def q_dedup_url(spark, sf_dir):
    """DUP-1, aggregate form."""
    return dedup.first_per_key(_dedup_input(spark, sf_dir), ["url"], ["event_time", "record_id"])


def q_dedup_url_window(spark, sf_dir):
    """DUP-1, ``row_number() = 1`` form (same result)."""
    return dedup.first_per_key_window(_dedup_input(spark, sf_dir), ["url"], ["event_time", "record_id"])


def q_dedup_cross_batch(spark, sf_dir):
    """DUP-2: each URL once, at its first batch and line."""
    v = _view(spark, sf_dir).select("url", "record_id", "batch_id", "batch_url", "line_no")
    v = quality.require_not_null(v, ["url"])
    return dedup.first_across_batches(v, "url", "batch_id", "line_no")


def q_gkg_clean(spark, sf_dir):
    """JOB-1 + PRJ-10 (flagship): one cleaned, labelled row per article URL."""
    return clean_plan.clean(_gkg(spark, sf_dir))


def q_preprocess(spark, sf_dir):
    """JOB-2 without the vector: clean, label, text."""
    return clean_plan.preprocess(_gkg(spark, sf_dir))


def q_preview_topn(spark, sf_dir):
    """SNK-7: the preview, ordered so it is reproducible (``show(20)``)."""
    out = clean_plan.clean(_gkg(spark, sf_dir))
    return (out.select("url", "event_time", "tone_score", "sentiment_label", "source")
            .orderBy("event_time", "url").limit(20))


def _records(spark, sf_dir):
    lines = landed_lines(spark, sf_dir)
    return normalize.normalize(lines, ingested_at=_ingested_at(), keep=("batch_url", "batch_id"))


def q_normalize_records(spark, sf_dir):
    """JOB-4: producer parse (ragged-safe fields, reject rule, ISO time, tone, pipes)."""
    return _records(spark, sf_dir).drop("batch_url", "batch_id")


def q_batch_lineage(spark, sf_dir):
    """PRJ-15: ``batch_url``, ``is_first_batch`` and ``batch_id`` per record."""
    recs = _records(spark, sf_dir)
    first = recs.agg(F.min("batch_id").alias("__first"))
    return (recs.crossJoin(F.broadcast(first))
            .select("record_id", "batch_url", (F.col("batch_id") == F.col("__first")).alias("is_first_batch"),
                    "batch_id"))


def q_batch_status(spark, sf_dir):
    """SNK-3 + AGG-1 / AGG-5: one status row per published archive."""
    from newsflow.sinks.publish import batch_status
    recs = _records(spark, sf_dir)
    return batch_status(recs, "batch_url", "batch_id", timestamp=_ingested_at())


def q_new_files(spark, sf_dir):
    """SRC-9 / DUP-3: announced archives not yet published (``left_anti``)."""
    from newsflow.sinks.publish import batch_status
    announced = manifest_src.latest_urls(manifest_lines(spark, sf_dir), "manifest", "line_no")
    announced = announced.filter(F.col("kind") == "gkg").select(F.col("url").alias("batch_url")).distinct()
    published = batch_status(_records(spark, sf_dir), "batch_url", "batch_id", timestamp=_ingested_at())
    return dedup.drop_seen(announced, published, ["batch_url"])


def q_drop_seen_indexed(spark, sf_dir):
    """DUP-2 / DUP-3 over an indexed history: keys (URL and hour) of the later half of the days that no
    earlier day holds. Every earlier day is one part of the history."""
    from newsflow.operators.history import KeyHistory
    from newsflow.session import shared_path
    v = _view(spark, sf_dir).filter("url IS NOT NULL").select(
        F.concat_ws("#", "url", F.substring("raw_date", 9, 2)).alias("key"), "batch_id")
    days = v.agg(F.min("batch_id").alias("lo"), F.max("batch_id").alias("hi")).withColumn(
        "middle", F.floor((F.col("lo") + F.col("hi")) / 2))
    v = v.crossJoin(F.broadcast(days.select("middle")))
    history = KeyHistory(spark, shared_path(spark, "history"))
    history.append(v.filter("batch_id <= middle"), "key", F.col("batch_id").cast("string"))
    return history.drop_seen(v.filter("batch_id > middle").select("key").distinct(), "key")


def q_output_rows(spark, sf_dir):
    """PRJ-16 over the stream path in batch form: wire parse, dedup per batch, label, 12 columns."""
    from newsflow.streaming.job import consume_records
    return consume_records(_records(spark, sf_dir), batch_id_col="batch_id")


def q_batch_lineage_records(spark, sf_dir):
    recs = _records(spark, sf_dir)
    first = recs.agg(F.min("batch_id").alias("__first"))
    return (recs.crossJoin(F.broadcast(first))
            .withColumn("is_first_batch", F.col("batch_id") == F.col("__first")).drop("__first"))


def q_publish_json(spark, sf_dir):
    """SNK-1 + PRJ-13: keyed JSON messages, checked on the key and the fields read back."""
    from newsflow.sinks.publish import to_messages
    msgs = to_messages(q_batch_lineage_records(spark, sf_dir).drop("batch_id"), key_col="url")
    return msgs.select(F.col("key").cast("string").alias("key"),
                       F.from_json(F.col("value").cast("string"), WIRE_SCHEMA).alias("d")).select("key", "d.*")


def q_legacy_records(spark, sf_dir):
    """JOB-5: wide scan -> polarity -> comma lists -> first send per URL."""
    lines = landed_lines(spark, sf_dir, ragged=True)
    rows = legacy.wide_scan_skip_bad(lines, LEGACY_PRODUCER_COLUMNS, "batch_url", "line_no", keep=("batch_id",))
    recs = legacy.legacy_records(rows, event_ts=F.col("batch_id").cast("bigint") * DAY_MS)
    return legacy.send_new_urls(recs, "batch_id", "line_no")


def q_legacy_readback(spark, sf_dir):
    """SNK-2 + SRC-11 + FLT-4: legacy messages (no key) read back with the 5-field reader schema."""
    from newsflow.schemas import LEGACY_READ_SCHEMA
    from newsflow.sinks.publish import to_messages
    from newsflow.streaming.job import parse_wire
    msgs = to_messages(q_legacy_records(spark, sf_dir).drop("batch_url", "line_no", "batch_id"), key_col=None)
    return parse_wire(msgs, LEGACY_READ_SCHEMA).filter(F.col("source_url").isNotNull())


# --- text -----------------------------------------------------------------------------------

def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def q_tokens(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", text.tokenize("text").alias("tokens"))
    return text.term_counts(docs, "doc_id", "tokens")


def q_tokens_filtered(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", text.remove_stop_words(text.tokenize("text")).alias("tokens"))
    return text.term_counts(docs, "doc_id", "tokens")


def q_doc_freq(spark, sf_dir):
    return text.document_frequency(q_tokens_filtered(spark, sf_dir), "doc_id")


def q_tfidf(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", text.remove_stop_words(text.tokenize("text")).alias("tokens"))
    out = text.tfidf(docs, "doc_id", "tokens")
    return out.select("doc_id", "term", "tf", "df", F.round("idf", 6).alias("idf"),
                      F.round("tfidf", 6).alias("tfidf"))


def q_hashing_tf(spark, sf_dir):
    """ML-3: Spark ML hashed term frequencies (10,000 buckets), checked on each vector's sum (its number of terms)."""
    from pyspark.ml.functions import vector_to_array
    out = text.hashed_term_frequencies(_docs(spark, sf_dir), "text")
    counted = F.aggregate(vector_to_array("raw_features"), F.lit(0.0), lambda a, x: a + x)
    return out.select("doc_id", counted.cast("long").alias("n_terms"))


# --- aggregates and round trips ---------------------------------------------------------------

def q_range_sum(spark, sf_dir):
    """SRC-13 / AGG-2: distributed sum over the id range of ``events`` with its closed form."""
    ev = read_table(spark, sf_dir, "events")
    return ev.agg(F.sum("event_id").alias("total"), F.count(F.lit(1)).alias("n"),
                  ((F.count(F.lit(1)) * (F.count(F.lit(1)) - 1)) / 2).cast("bigint").alias("expected"))


def q_parquet_roundtrip(spark, sf_dir):
    """SRC-12 / SNK-5: overwrite ``events`` as Parquet in the shared folder and read it back."""
    from newsflow.sinks.parquet import roundtrip
    return roundtrip(spark, read_table(spark, sf_dir, "events"), "roundtrip")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gkg_clean": q_gkg_clean,
    "gkg_project": q_gkg_project,
    "ragged_fields": q_ragged_fields,
    "wide_scan_skip_bad": q_wide_scan_skip_bad,
    "wide_scan_quoted": q_wide_scan_quoted,
    "manifest_parse": q_manifest_parse,
    "manifest_first": q_manifest_first,
    "parse_compact_ts": q_parse_compact_ts,
    "compact_to_iso": q_compact_to_iso,
    "iso_to_ts": q_iso_to_ts,
    "tone_score": q_tone_score,
    "tone_label": q_tone_label,
    "polarity": q_polarity,
    "clean_list": q_clean_list,
    "list_pipe": q_list_pipe,
    "list_comma": q_list_comma,
    "build_text": q_build_text,
    "url_host": q_url_host,
    "json_flatten": q_json_flatten,
    "required_fields": q_required_fields,
    "required_nonempty": q_required_nonempty,
    "reject_counts": q_reject_counts,
    "dedup_url": q_dedup_url,
    "dedup_url_window": q_dedup_url_window,
    "dedup_cross_batch": q_dedup_cross_batch,
    "preprocess": q_preprocess,
    "preview_topn": q_preview_topn,
    "normalize_records": q_normalize_records,
    "batch_lineage": q_batch_lineage,
    "batch_status": q_batch_status,
    "new_files": q_new_files,
    "drop_seen_indexed": q_drop_seen_indexed,
    "output_rows": q_output_rows,
    "publish_json": q_publish_json,
    "legacy_records": q_legacy_records,
    "legacy_readback": q_legacy_readback,
    "tokens": q_tokens,
    "tokens_filtered": q_tokens_filtered,
    "doc_freq": q_doc_freq,
    "tfidf": q_tfidf,
    "hashing_tf": q_hashing_tf,
    "range_sum": q_range_sum,
    "parquet_roundtrip": q_parquet_roundtrip,
}


# --- file-backed operators (inputs written by Spark to the shared checkpoint folder) ----------

def q_scan_gkg(spark, sf_dir):
    """SRC-1 + SRC-2: tab-separated files written from the raw lines, scanned with the 27-field schema."""
    from newsflow.session import shared_path
    from newsflow.sources.gkg import read_gkg, write_lines
    path = shared_path(spark, "scan_gkg")
    write_lines(landed_lines(spark, sf_dir), path)
    return read_gkg(spark, path)


def q_zip_scan(spark, sf_dir):
    """SRC-6: lines written into zip archives (per batch and task), streamed back out and projected."""
    from newsflow.session import shared_path
    from newsflow.sources.archives import read_archives, write_archives
    path = shared_path(spark, "zip_scan")
    write_archives(landed_lines(spark, sf_dir), path, "batch_url", "line_no").count()
    lines = read_archives(spark, path)
    return normalize.project_lines(lines, keep=("member",))


def q_write_partitioned(spark, sf_dir):
    """SNK-4: the output rows written partitioned by label, read back."""
    from newsflow.session import shared_path
    from newsflow.sinks.parquet import write_partitioned
    path = shared_path(spark, "write_partitioned")
    write_partitioned(q_output_rows(spark, sf_dir), path, mode="overwrite")
    return spark.read.parquet(path)


def q_idempotent_sink(spark, sf_dir):
    """STR-5: every batch written twice (a replay) with per-batch overwrite; one copy remains."""
    from newsflow.session import shared_path
    from newsflow.sinks.parquet import read_output, write_batches
    path = shared_path(spark, "idempotent_sink")
    rows = q_output_rows(spark, sf_dir)
    write_batches(rows, path, "r0")
    write_batches(rows, path, "r0")
    return read_output(spark, path, "r0").drop("run")


def q_logged_tables(spark, sf_dir):
    """SNK-3 + STR-5 + R7: output rows of the batches and their counts as two tables of one commit log. The later
    half is written twice (a replay), one transaction is never finished (a crash), then the rows are compacted."""
    from newsflow.session import shared_path
    from newsflow.sinks.commits import TableLog
    log = TableLog(spark, shared_path(spark, "logged_tables"))
    rows = q_output_rows(spark, sf_dir)
    half = F.col("batch_id") % 2
    for part in (0, 1, 1):
        with log.begin(batch=("r0", part)) as tx:
            mine = tx.write("rows", rows.filter(half == part), ["sentiment_label"])
            tx.write("counts", mine.groupBy("batch_id").agg(F.count(F.lit(1)).alias("batch_rows")))
    log.begin().write("rows", log.read("rows"), ["sentiment_label"])
    log.compact("rows")
    return log.read("rows").join(log.read("counts"), "batch_id")


def q_stream_rejects(spark, sf_dir):
    """FLT-3 + AGG-3 in the stream's callback: the wire messages it does not use, by reason and archive. Every
    line is sent; of every 17th the message is no JSON."""
    from newsflow.session import shared_path
    from newsflow.sinks.parquet import read_output
    from newsflow.sinks.publish import to_messages
    from newsflow.streaming.job import BatchWriter
    fields = normalize.project_lines(landed_lines(spark, sf_dir), keep=("batch_url",))
    recs = normalize.to_records(fields).withColumn("url", F.nullif("url", F.lit("")))
    messages = to_messages(recs, keep=("record_id",))
    broken = F.concat(F.lit("<").cast("binary"), "value")
    number = F.col("record_id").try_cast("long")
    messages = messages.select("key", F.when(number % 17 == 0, broken).otherwise(F.col("value")).alias("value"))
    out, rejected = shared_path(spark, "stream_rejects"), shared_path(spark, "stream_rejects_rejected")
    BatchWriter(out, "r0", rejected_path=rejected)(messages, 0)
    return read_output(spark, rejected, "r0").groupBy("reason", "batch_url").agg(
        F.count(F.lit(1)).alias("n"), F.min("record_id").alias("first_id"), F.max("record_id").alias("last_id"))


def _stream_input(spark, sf_dir, whole: bool = False) -> str:
    """Wire messages (JSON lines) in files of one batch each.

    A batch of more than the advisory partition size is written by several tasks, in one file each; ``whole``: the
    hash of ``batch_id`` brings a batch into one task and file (for the job that takes a file as its batch).
    """
    from newsflow.session import shared_path
    from newsflow.sinks.parquet import few_files
    path = shared_path(spark, "wire")
    recs = q_batch_lineage_records(spark, sf_dir)
    fields = [c for c in recs.columns if c != "batch_id"]
    lines = recs.select("batch_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))
    lines = lines.repartition("batch_id") if whole else few_files(lines, ["batch_id"])
    lines.write.mode("overwrite").partitionBy("batch_id").text(path)
    return path


def q_stream_ingest(spark, sf_dir):
    """SRC-10 + STR-4: file stream (rate-limited by files per trigger) -> parsed wire records -> Parquet sink."""
    from newsflow.session import shared_path
    from newsflow.streaming.job import parse_wire, stream_source
    src = _stream_input(spark, sf_dir)
    out, ckpt = shared_path(spark, "stream_ingest"), shared_path(spark, "stream_ingest_ckpt")
    stream = parse_wire(stream_source(spark, "files", {"maxFilesPerTrigger": 2}, path=src))
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def q_stream_feed(spark, sf_dir):
    """SRC-7 + SRC-9 + SRC-6 as a stream: one archive per batch, each announced by a manifest, published once."""
    from newsflow.session import shared_path
    from newsflow.sources.archives import write_archives
    from newsflow.streaming.feed import feed_stream
    arc, man, out = (shared_path(spark, f"feed_{d}") for d in ("archives", "manifests", "out"))
    made = write_archives(landed_lines(spark, sf_dir).repartition("batch_url"), arc, "batch_url", "line_no")
    (made.select(F.md5("archive").alias("m"), F.concat(F.lit("0 0 "), "archive").alias("value"))
     .write.partitionBy("m").text(man))
    q = (feed_stream(spark, man, arc).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", shared_path(spark, "feed_ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return normalize.project_lines(spark.read.parquet(out), keep=("member",))


def q_stream_job(spark, sf_dir):
    """JOB-3: the micro-batch job over a file stream (one batch file per trigger), idempotent output, read
    back without the stream's own run and batch numbers."""
    from newsflow.session import shared_path
    from newsflow.sinks.parquet import read_output
    from newsflow.streaming.job import run_key, start_stream, stream_source
    src = _stream_input(spark, sf_dir, whole=True)
    out, ckpt = shared_path(spark, "stream_job"), shared_path(spark, "stream_job_ckpt")
    q = start_stream(stream_source(spark, "files", {"maxFilesPerTrigger": 1}, path=src), out, ckpt,
                     trigger={"availableNow": True})
    q.awaitTermination()
    return read_output(spark, out, run_key(ckpt)).drop("run", "batch_id")


def q_stream_dedup(spark, sf_dir):
    """DUP-2 (stream form): first arrival of each URL within the watermark, across micro-batches.

    The delay (31 days) covers the whole 30-day span, so no row depends on file order
    (the late-row drop itself is unit-tested); which record of a URL arrives first does,
    so the result is the URLs.
    """
    from newsflow.session import shared_path
    from newsflow.streaming.dedup import dedup_within_watermark
    from newsflow.streaming.job import parse_wire, stream_source
    src = _stream_input(spark, sf_dir)
    out, ckpt = shared_path(spark, "stream_dedup"), shared_path(spark, "stream_dedup_ckpt")
    recs = parse_wire(stream_source(spark, "files", {"maxFilesPerTrigger": 2}, path=src))
    recs = recs.withColumn("event_time", iso_to_ts("event_time", ntz=False)).dropna(subset=["url", "event_time"])
    deduped = dedup_within_watermark(recs, ["url"], "event_time", "31 days")
    q = (deduped.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select("url")


def q_stream_dedup_bounded(spark, sf_dir):
    """DUP-2 with the legacy loop's bound by count: no bucket is full here, so every URL passes once.
    Which record of a URL comes first depends on the file order, so the result is the URLs."""
    from newsflow.session import shared_path
    from newsflow.streaming.dedup import dedup_bounded, use_rocksdb
    from newsflow.streaming.job import parse_wire, stream_source
    src = _stream_input(spark, sf_dir)
    out, ckpt = shared_path(spark, "stream_bounded"), shared_path(spark, "stream_bounded_ckpt")
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(spark)
    recs = parse_wire(stream_source(spark, "files", {"maxFilesPerTrigger": 8}, path=src))
    recs = recs.dropna(subset=["url"]).select("url", "record_id", "batch_url")
    q = (dedup_bounded(recs, "url", ["batch_url", "record_id"]).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    return spark.read.parquet(out).select("url")


def q_preprocess_features(spark, sf_dir):
    """JOB-2 with the model (ML-5 .. ML-9): fit TF-IDF on the cleaned text, save a version, load, score;
    the vectors are checked on their number of terms."""
    from newsflow.operators.model import ModelStore, featurize
    from newsflow.session import shared_path
    prepared = clean_plan.preprocess(_gkg(spark, sf_dir))
    store = ModelStore(spark, shared_path(spark, "models"))
    store.fit_and_save(prepared)
    model = ModelStore(spark, store.root).load()
    from pyspark.ml.functions import vector_to_array
    scored = featurize(model, prepared)
    counted = F.aggregate(vector_to_array("raw_features"), F.lit(0.0), lambda a, x: a + x)
    return scored.select("record_id", "url", "sentiment_label", counted.cast("long").alias("n_terms"))


def q_idf_refit(spark, sf_dir):
    """AGG-4 + ML-4: counts kept per batch (the document's source), one batch written twice, merged into a model and
    held against ``IDF.fit`` on all documents: the hashed terms whose frequency or weight differs."""
    from newsflow.operators.idf_state import IdfState
    from newsflow.session import shared_path
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source")
    state, batch = IdfState(spark, shared_path(spark, "idf_state")), F.coalesce("source", F.lit("none"))
    state.add(docs, batch)
    state.add(docs, batch)  # a replay
    mine, fitted = state.model(), text.build_ml_pipeline().fit(docs).stages[-1]
    pairs = zip(mine.docFreq, fitted.docFreq, mine.idf.toArray().tolist(), fitted.idf.toArray().tolist())
    found = spark.createDataFrame(list(pairs), "f long, g long, w double, v double")
    return found.agg(F.lit(mine.numDocs).cast("long").alias("n_docs"), F.count_if(F.col("f") != F.col("g")).alias("other_counts"),
                     F.count_if(F.abs(F.col("w") - F.col("v")) > 1e-12).alias("other_weights"))


QUERIES.update({
    "idf_refit": q_idf_refit,
    "scan_gkg": q_scan_gkg,
    "zip_scan": q_zip_scan,
    "write_partitioned": q_write_partitioned,
    "idempotent_sink": q_idempotent_sink,
    "logged_tables": q_logged_tables,
    "stream_rejects": q_stream_rejects,
    "stream_ingest": q_stream_ingest,
    "stream_feed": q_stream_feed,
    "stream_job": q_stream_job,
    "stream_dedup": q_stream_dedup,
    "stream_dedup_bounded": q_stream_dedup_bounded,
    "preprocess_features": q_preprocess_features,
})
