"""The producer as one distributed batch job (SRC-7, SRC-9, SRC-6, JOB-4, SNK-1, SNK-3, SNK-6).

manifests -> latest archive URL per manifest -> not yet published (anti-join with
the status table on the archive's file name) -> those archives unzipped once, one a
task, into the landing table -> records (JOB-4, no Python per row), messages (Kafka
topic or a messages table), counts and status, all from the landing table.

The reference did this in one Python process per poll; here many archives and
manifests are handled at once. Downloading is not part of it: archive files are
looked up by name under ``archive_root``.

Replay: landing and messages are replaced per archive, the status is written last
in one append. A pass that failed before it leaves no status row, so the next pass
publishes the same archives again and overwrites what the failed one wrote. (A Kafka
topic keeps both; its consumers drop repeated keys.)

With ``tables`` (a ``TableLog``) the three are the tables ``landing``, ``messages`` and ``status`` of one commit log:
a pass is one transaction, so no reader ever sees records without their status. A pass that another one overtook
raises ``Conflict``, leaves nothing and is repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.dedup import drop_seen
from newsflow.operators.quality import reject_counts
from newsflow.plans.normalize import normalize, producer_valid, project_lines
from newsflow.schemas import STATUS_EVENT, STATUS_SCHEMA
from newsflow.session import shared_path
from newsflow.sinks.commits import TableLog, Transaction
from newsflow.sinks.parquet import land_raw, path_exists
from newsflow.sinks.publish import publish, publish_status, to_messages
from newsflow.sources.archives import read_archives
from newsflow.sources.manifest import latest_urls, read_manifests


@dataclass
class IngestResult:
    new_archives: DataFrame
    records: DataFrame
    status: DataFrame
    counts: DataFrame


def archive_name(url_col: str = "batch_url"):
    """File name of an archive URL."""
    return F.element_at(F.split(url_col, "/"), -1)


def announced_archives(spark: SparkSession, manifest_path: str, kind: str = "gkg") -> DataFrame:
    """``batch_url`` of the latest archive of ``kind`` named by each manifest (distinct)."""
    latest = latest_urls(read_manifests(spark, manifest_path), "manifest", "line_no")
    return latest.filter(F.col("kind") == kind).select(F.col("url").alias("batch_url")).distinct()


class Folders:
    """A pass's outputs as three folders, written one after the other."""

    def __init__(self, spark: SparkSession, status: str, messages: str | None, landing: str | None):
        self.spark, self.status_path, self.messages_path = spark, status, messages
        self.landing_path = landing or shared_path(spark, "landing")

    def published(self) -> DataFrame | None:
        return self.spark.read.parquet(self.status_path) if path_exists(self.spark, self.status_path) else None

    def land(self, lines: DataFrame) -> DataFrame:
        land_raw(lines, self.landing_path)
        schema = "line_no long, value string, first_width int, batch_url string"
        return self.spark.read.schema(schema).parquet(self.landing_path)

    def messages(self, rows: DataFrame) -> None:
        if self.messages_path:
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_url").parquet(self.messages_path))

    def status(self, rows: DataFrame) -> DataFrame:
        rows.write.mode("append").parquet(self.status_path)
        return self.spark.read.parquet(self.status_path)


class Logged:
    """A pass's outputs as generations of one transaction."""

    def __init__(self, tx: Transaction):
        self.tx = tx

    def published(self) -> DataFrame | None:
        return self.tx.log.read("status", self.tx.base)

    def land(self, lines: DataFrame) -> DataFrame:
        return self.tx.write("landing", lines, ["batch_url"])

    def messages(self, rows: DataFrame) -> None:
        self.tx.write("messages", rows, ["batch_url"])

    def status(self, rows: DataFrame) -> DataFrame:
        return self.tx.write("status", rows)


def ingest(spark: SparkSession, manifest_path: str, archive_root: str, status_path: str | None = None,
           messages_path: str | None = None, landing_path: str | None = None,
           kafka: dict | None = None, ingested_at=None, tables: TableLog | None = None) -> IngestResult:
    """Run one ingest pass; returns the frames it wrote (read from the landing and status tables).

    An archive announced under several URLs (hosts, schemes) is published once, under the
    smallest. ``is_first_batch`` is true for the earliest archive of the very first pass (no
    status table yet). ``kafka``: ``bootstrap_servers``, ``topic``, optional ``status_topic``.
    ``tables`` takes the place of the three paths.
    """
    if (status_path is None) == (tables is None):
        raise ValueError("ingest needs either status_path or tables")
    if tables is None:
        out = Folders(spark, status_path, messages_path, landing_path)
        result = _one_pass(spark, manifest_path, archive_root, out, kafka, ingested_at)
    else:
        with tables.begin(exclusive=True) as tx:
            result = _one_pass(spark, manifest_path, archive_root, Logged(tx), kafka, ingested_at)
        result.status = tables.read("status", tx.version)
    if kafka and kafka.get("status_topic"):
        mine = result.status.join(result.new_archives.select("batch_url"), "batch_url", "left_semi")
        publish_status(mine.select(*STATUS_SCHEMA.names), kafka["status_topic"], kafka["bootstrap_servers"])
    return result


def _one_pass(spark: SparkSession, manifest_path: str, archive_root: str, out: Folders | Logged, kafka: dict | None,
              ingested_at) -> IngestResult:
    announced = announced_archives(spark, manifest_path).withColumn("archive_name", archive_name())
    published = out.published()
    have_status = published is not None
    published = published if have_status else spark.createDataFrame([], STATUS_SCHEMA)
    new = drop_seen(announced, published.select(archive_name().alias("archive_name")), ["archive_name"])
    new = new.groupBy("archive_name").agg(F.min("batch_url").alias("batch_url"))
    unzipped = (read_archives(spark, archive_root, only_names=new)
                .withColumn("archive_name", archive_name("archive")).join(new, "archive_name"))
    landed = out.land(unzipped.select("batch_url", "line_no", "value", "first_width"))
    lines = landed.join(new.select("batch_url"), "batch_url", "left_semi")

    found = lines.groupBy("batch_url").agg(F.count(F.lit(1)).alias("lines")).select("batch_url")
    if have_status:
        first = found.select("batch_url", F.lit(False).alias("is_first_batch"))
    else:
        lowest = found.agg(F.min("batch_url").alias("__first"))
        first = found.crossJoin(F.broadcast(lowest)).select(
            "batch_url", (F.col("batch_url") == F.col("__first")).alias("is_first_batch"))
    recs = normalize(lines, ingested_at=ingested_at, keep=("batch_url",)).join(first, "batch_url")
    out.messages(to_messages(recs, keep=("batch_url",)))
    if kafka:
        publish(recs, kafka["topic"], kafka["bootstrap_servers"], key_col="url")
    counts = reject_counts(project_lines(lines, keep=("batch_url",)), producer_valid(), by=["batch_url"])
    ts = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    # An archive without one valid row is still published (with a count of 0).
    status = counts.join(first, "batch_url").select(
        F.lit(STATUS_EVENT).alias("event"), "batch_url", F.col("sent").cast("long").alias("record_count"),
        F.col("is_first_batch").alias("is_first"), ts.alias("timestamp"))
    return IngestResult(new, recs, out.status(status), counts)
