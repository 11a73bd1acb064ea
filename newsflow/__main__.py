"""Command-line entry (JOB-6): ``python -m newsflow <command> ...`` or ``spark-submit``.

  preprocess <tsv_path> [--show N]           clean, label, text, fit TF-IDF, show N rows
  ingest <manifests> <archives> (<status> [--messages P] [--landing P] | --tables ROOT) [--counts P]
         [--kafka-bootstrap S --topic T [--status-topic T]]
  stream <output> <checkpoint> (--files P [--files-per-trigger N] |
         --kafka-bootstrap S --topic T [--max-offsets N]) [--trigger "60 seconds"] [--models P] [--preview N]
         [--rejected P]
  readback <output> (--files P | --kafka-bootstrap S --topic T) [--legacy] [--preview N]
         everything a topic holds, as a Parquet table
  tables <root> (--compact TABLE | --vacuum)   care for the tables of ``ingest --tables``

The master and resources come from the submitter; nothing is hard-coded here.
"""

from __future__ import annotations

import argparse


def parser() -> argparse.ArgumentParser:
    from newsflow.schemas import MAX_RECORDS_PER_TRIGGER, TRIGGER_INTERVAL
    ap = argparse.ArgumentParser(prog="newsflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("preprocess")
    p.add_argument("path")
    p.add_argument("--show", type=int, default=20)
    p.add_argument("--models")
    i = sub.add_parser("ingest")
    for name in ("manifests", "archives"):
        i.add_argument(name)
    i.add_argument("status", nargs="?")
    for name in ("--tables", "--messages", "--landing", "--counts", "--kafka-bootstrap", "--topic", "--status-topic"):
        i.add_argument(name)
    s = sub.add_parser("stream")
    s.add_argument("output")
    s.add_argument("checkpoint")
    s.add_argument("--files")
    s.add_argument("--files-per-trigger", type=int, default=1)
    s.add_argument("--kafka-bootstrap")
    s.add_argument("--topic")
    s.add_argument("--max-offsets", type=int, default=MAX_RECORDS_PER_TRIGGER)
    s.add_argument("--trigger", default=TRIGGER_INTERVAL)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--models")
    s.add_argument("--preview", type=int, default=0)
    s.add_argument("--rejected")
    r = sub.add_parser("readback")
    r.add_argument("output")
    for name in ("--files", "--kafka-bootstrap", "--topic"):
        r.add_argument(name)
    r.add_argument("--legacy", action="store_true")
    r.add_argument("--preview", type=int, default=0)
    t = sub.add_parser("tables")
    t.add_argument("root")
    t.add_argument("--compact")
    t.add_argument("--vacuum", action="store_true")
    return ap


def source_of(args) -> tuple[str, dict, str | None]:
    """``(kind, options, path)`` of the source of ``stream`` and ``readback`` (which reads all there is)."""
    from newsflow.streaming.job import kafka_source_options
    if args.kafka_bootstrap:
        if not args.topic:
            raise SystemExit("--kafka-bootstrap needs --topic")
        limit = args.max_offsets if args.cmd == "stream" else None
        return "kafka", kafka_source_options(args.kafka_bootstrap, args.topic, limit), None
    if not args.files:
        raise SystemExit(f"{args.cmd} needs --files or --kafka-bootstrap")
    return "files", {"maxFilesPerTrigger": args.files_per_trigger} if args.cmd == "stream" else {}, args.files


def kafka_of(args) -> dict | None:
    """The Kafka sink of ``ingest``."""
    if not args.kafka_bootstrap:
        return None
    if not args.topic:
        raise SystemExit("--kafka-bootstrap needs --topic")
    return {"bootstrap_servers": args.kafka_bootstrap, "topic": args.topic, "status_topic": args.status_topic}


def trigger_of(args) -> dict:
    return {"availableNow": True} if args.available_now else {"processingTime": args.trigger}


def main(argv=None) -> None:
    from newsflow.session import get_session
    args = parser().parse_args(argv)
    spark = get_session("newsflow-" + args.cmd)

    if args.cmd == "preprocess":
        from newsflow.operators.model import ModelStore, featurize
        from newsflow.plans.clean import preprocess
        from newsflow.session import shared_path
        from newsflow.sources.gkg import read_gkg
        prepared = preprocess(read_gkg(spark, args.path))
        store = ModelStore(spark, args.models or shared_path(spark, "models", unique=False))
        model = store.load_or_train(prepared)
        out = featurize(model, prepared) if model is not None else prepared
        out.select("url", "event_time", "tone_score", "sentiment_label", "source").show(args.show, truncate=80)
    elif args.cmd == "ingest":
        from newsflow.plans.ingest import ingest
        from newsflow.sinks.commits import TableLog
        tables = TableLog(spark, args.tables) if args.tables else None
        res = ingest(spark, args.manifests, args.archives, args.status, args.messages, args.landing,
                     kafka=kafka_of(args), tables=tables)
        if args.counts:  # every archive's counters; the print below is a preview
            res.counts.write.mode("overwrite").parquet(args.counts)
        res.counts.show(truncate=False)
    elif args.cmd == "readback":
        from newsflow.schemas import LEGACY_READ_SCHEMA, WIRE_SCHEMA
        from newsflow.streaming.job import bounded_records
        kind, options, path = source_of(args)
        rows = bounded_records(spark, kind, options, path, LEGACY_READ_SCHEMA if args.legacy else WIRE_SCHEMA)
        rows.write.mode("overwrite").parquet(args.output)
        if args.preview:
            spark.read.parquet(args.output).show(args.preview, truncate=80)
    elif args.cmd == "tables":
        from newsflow.sinks.commits import TableLog
        log = TableLog(spark, args.root)
        if args.compact:
            print("version", log.compact(args.compact))
        if args.vacuum:
            print("deleted", *log.vacuum(), sep="\n")
    else:
        from newsflow.operators.model import ModelStore
        from newsflow.streaming.job import start_stream, stream_source
        kind, options, path = source_of(args)
        store = ModelStore(spark, args.models) if args.models else None
        start_stream(stream_source(spark, kind, options, path=path), args.output, args.checkpoint,
                     trigger=trigger_of(args), model_store=store, preview=args.preview,
                     rejected_path=args.rejected).awaitTermination()


if __name__ == "__main__":
    main()
