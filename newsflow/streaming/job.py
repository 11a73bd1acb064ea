"""The micro-batch job (JOB-3, STR-1 .. STR-7) and its batch twin.

``consume_records`` is the per-batch logic as a pure DataFrame function, used
both by the stream's ``foreachBatch`` callback and by the batch query
``output_rows``. The callback adds what only a stream has: the empty-batch
guard, the model lifecycle and the idempotent write keyed by ``batch_id``.
"""

from __future__ import annotations

import hashlib
import logging
from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions import iso_to_ts
from newsflow.operators.dedup import first_per_key
from newsflow.operators.quality import observe_counts, split_valid
from newsflow.plans.clean import add_text, add_tone_label
from newsflow.schemas import MAX_RECORDS_PER_TRIGGER, OUTPUT_COLUMNS, TRIGGER_INTERVAL, WIRE_SCHEMA

log = logging.getLogger(__name__)


def parse_wire(df: DataFrame, schema=WIRE_SCHEMA) -> DataFrame:
    """PRJ-12: message ``value`` bytes -> JSON struct -> flat columns (permissive: bad JSON -> NULLs)."""
    return df.select(F.from_json(F.col("value").cast("string"), schema).alias("d")).select("d.*")


def reject_reason() -> Column:
    """FLT-3 for wire records: why one is not used, ``malformed``, ``no_url`` or ``no_time`` (NULL: it is used).

    A message that is no JSON object of the wire schema parses to NULL fields.
    """
    return (F.when(F.col("record_id").isNull() & F.col("url").isNull(), F.lit("malformed"))
            .when(F.col("url").isNull(), F.lit("no_url"))
            .when(iso_to_ts("event_time").isNull(), F.lit("no_time")))


def consume_records(records: DataFrame, batch_id_col: str = "batch_id", with_text: bool = False) -> DataFrame:
    """PRJ-3 -> FLT-1 -> DUP-1 -> PRJ-10 -> PRJ-16 for wire records of one or more batches.

    Dedup is per ``(batch_id, url)``: inside one micro-batch, as the stream does.
    ``with_text`` adds the model input ``text`` (PRJ-9, built before ``all_names`` is dropped).
    """
    parsed = records.withColumns({
        "event_time": iso_to_ts("event_time"),
        "tone_score": F.col("tone_score").cast("float"),
    })
    valid = parsed.dropna(subset=["url", "event_time"])
    first = first_per_key(valid.select("record_id", "event_time", "source", "url", "themes", "persons",
                                       "organizations", "locations", "all_names", "tone_score", "batch_url",
                                       batch_id_col),
                          [batch_id_col, "url"], ["event_time", "record_id"])
    out = add_tone_label(first)
    extra = []
    if with_text:
        out, extra = add_text(out), ["text"]
    return out.select(*OUTPUT_COLUMNS[:-1], F.col(batch_id_col).cast("int").alias("batch_id"), *extra)


def kafka_source_options(bootstrap: str, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    """Options of a Kafka reader; ``max_offsets`` is the rate limit of a stream (STR-4)."""
    limit = {} if max_offsets is None else {"maxOffsetsPerTrigger": str(max_offsets)}
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": "earliest", **limit}


def stream_source(spark: SparkSession, kind: str, options: dict | None = None, path: str | None = None):
    """SRC-10: a streaming DataFrame with a binary ``value`` column.

    ``kind='kafka'``: ``readStream.format('kafka')`` (needs the connector jar);
    defaults earliest offsets, no failure on data loss, 50,000 offsets per trigger.
    ``kind='files'``: text files of JSON lines in ``path``, ``maxFilesPerTrigger``
    from ``options`` (default 1); the same ``value`` column, for tests and replays.
    """
    opts = dict(options or {})
    if kind == "kafka":
        defaults = {"startingOffsets": "earliest", "failOnDataLoss": "false",
                    "maxOffsetsPerTrigger": str(MAX_RECORDS_PER_TRIGGER)}
        return spark.readStream.format("kafka").options(**{**defaults, **opts}).load()
    if kind == "files":
        reader = spark.readStream.format("text").option("maxFilesPerTrigger", opts.pop("maxFilesPerTrigger", 1))
        for k, v in opts.items():
            reader = reader.option(k, v)
        return reader.load(path).select(F.lit(None).cast("binary").alias("key"),
                                        F.col("value").cast("binary").alias("value"))
    raise ValueError(f"unknown stream source kind: {kind}")


def bounded_records(spark: SparkSession, kind: str, options: dict | None = None, path: str | None = None,
                    schema=WIRE_SCHEMA) -> DataFrame:
    """SRC-11: everything a topic (``kafka``) or a folder of JSON lines (``files``) holds now, parsed and flattened.

    A topic is read from its earliest to its latest offsets unless ``options`` say otherwise.
    """
    if kind == "kafka":
        bounds = {"startingOffsets": "earliest", "endingOffsets": "latest"}
        return parse_wire(spark.read.format("kafka").options(**{**bounds, **(options or {})}).load(), schema)
    if kind == "files":
        return parse_wire(spark.read.options(**(options or {})).text(path), schema)
    raise ValueError(f"unknown source kind: {kind}")


def run_key(checkpoint: str) -> str:
    """A stable id for one checkpoint: batch ids restart at 0 with a new checkpoint."""
    return "r" + hashlib.sha1(checkpoint.encode("utf-8")).hexdigest()[:12]


@dataclass
class BatchWriter:
    """STR-1 callback: parse, clean, label, optionally score, write idempotently.

    ``model_store``: a ``newsflow.operators.model.ModelStore``; when set, the first
    batch without a stored model trains one (STR-6) and every batch is scored (ML-9).
    The vector is not written (the output table holds readable columns only).
    ``preview`` prints that many rows of each batch (SNK-7). ``rejected_path``: a table of the wire records
    that were not used, with their ``reason``, replaced per batch as the output is.
    """

    output_path: str
    run: str
    model_store: object | None = None
    preview: int = 0
    rejected_path: str | None = None
    #: Counters of the last batches; older ones are in the log. ``rows`` = ``sent`` + ``rejected``.
    stats: deque = field(default_factory=lambda: deque(maxlen=1000))

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        from newsflow.sinks.parquet import write_batch
        # The parsed batch (at most one trigger's records) feeds the rejects, the
        # model and the write: parse once.
        parsed = parse_wire(batch_df).withColumns({"batch_id": F.lit(int(batch_id)), "reason": reject_reason()}).persist()
        try:
            # The counters are collected while the rejects are written, which needs no shuffle
            # (where there is one, an empty side would take the observed part of the plan with it).
            used = F.col("reason").isNull()
            observed, counters = observe_counts(parsed, f"{self.run}-{batch_id}", sent=used, rejected=~used,
                                                malformed=F.col("reason") == "malformed")
            rejects = split_valid(observed, used)[1]
            if self.rejected_path:
                write_batch(rejects, self.rejected_path, batch_id, self.run, ("reason",), clustered=False)
            else:
                rejects.write.format("noop").mode("overwrite").save()
            counts = counters.get
            out = consume_records(split_valid(parsed, used)[0], with_text=self.model_store is not None)
            out_cols = out.select(*OUTPUT_COLUMNS)
            if self.model_store is not None and counts["rows"] > counts["rejected"]:
                model = self.model_store.load_or_train(out)
                if model is not None:
                    # ML-9: scored rows; the vector is not written (the table holds readable columns)
                    out_cols = model.transform(out).select(*OUTPUT_COLUMNS)
            # A batch without valid rows still replaces (clears) its directory.
            write_batch(out_cols, self.output_path, batch_id, self.run)
            self.stats.append({"batch_id": batch_id, **counts})
            log.info("batch %s: %s", batch_id, counts)
            if self.preview:
                out_cols.show(self.preview, truncate=80)
        finally:
            parsed.unpersist()


def start_stream(source: DataFrame, output_path: str, checkpoint: str,
                 trigger: dict | None = None, model_store=None, query_name: str | None = None, preview: int = 0,
                 rejected_path: str | None = None):
    """JOB-3: ``foreachBatch`` + checkpoint + trigger (STR-1, STR-2, STR-3).

    ``trigger`` defaults to ``processingTime`` of 60 s; tests pass ``{'availableNow': True}``.
    Returns the ``StreamingQuery`` (``awaitTermination`` is STR-7).
    """
    writer = BatchWriter(output_path, run_key(checkpoint), model_store, preview, rejected_path)
    w = source.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL}))
    if query_name:
        w = w.queryName(query_name)
    return w.start()
