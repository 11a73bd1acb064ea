"""Keyed JSON publish and batch status (SNK-1, SNK-2, SNK-3, PRJ-13, AGG-1, AGG-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.schemas import STATUS_EVENT, STATUS_KEY


def to_messages(df: DataFrame, key_col: str | None = "url", value_cols: Sequence[str] | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-13 / SNK-1: ``(key, value)`` binary columns, value = UTF-8 JSON of the row.

    NULL fields are written as explicit ``null`` (as Python's ``json.dumps`` does).
    ``key_col=None`` gives the key-less legacy message (SNK-2); ``keep`` names columns to carry beside it.
    """
    cols = list(value_cols) if value_cols is not None else df.columns
    key = F.col(key_col).cast("binary") if key_col else F.lit(None).cast("binary")
    value = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).cast("binary")
    return df.select(key.alias("key"), value.alias("value"), *keep)


def kafka_options(bootstrap_servers: str, topic: str, options: dict | None = None) -> dict[str, str]:
    """Options of a Kafka writer."""
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, **(options or {})}


def publish(df: DataFrame, topic: str, bootstrap_servers: str, key_col: str | None = "url",
            options: dict | None = None) -> None:
    """SNK-1: write the messages to a Kafka topic (needs the Kafka connector on the classpath)."""
    to_messages(df, key_col).write.format("kafka").options(**kafka_options(bootstrap_servers, topic, options)).save()


def status_messages(status: DataFrame) -> DataFrame:
    """SNK-3 as messages: every status row under the key ``status``."""
    keyed = status.withColumn("__key", F.lit(STATUS_KEY))
    return to_messages(keyed, "__key", status.columns)


def publish_status(status: DataFrame, topic: str, bootstrap_servers: str, options: dict | None = None) -> None:
    """SNK-3: write the status rows to a Kafka topic."""
    status_messages(status).write.format("kafka").options(**kafka_options(bootstrap_servers, topic, options)).save()


def batch_status(records: DataFrame, batch_col: str = "batch_url", batch_id_col: str = "batch_id",
                 timestamp: Column | None = None) -> DataFrame:
    """SNK-3: ``(event, batch_url, record_count, is_first, timestamp)`` per batch.

    ``record_count`` is the number of published (valid) records. ``is_first`` marks
    the earliest batch; the global minimum is a one-row aggregate (bounded broadcast).
    """
    counts = records.groupBy(batch_col, batch_id_col).agg(F.count(F.lit(1)).alias("record_count"))
    first = counts.agg(F.min(batch_id_col).alias("__first"))
    ts = timestamp if timestamp is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return (counts.crossJoin(F.broadcast(first))
            .select(F.lit(STATUS_EVENT).alias("event"), F.col(batch_col).alias("batch_url"),
                    "record_count", (F.col(batch_id_col) == F.col("__first")).alias("is_first"),
                    ts.alias("timestamp")))
