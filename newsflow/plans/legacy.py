"""JOB-5: the legacy producer's record build (SRC-5, PRJ-11, PRJ-7, PRJ-18, DUP-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import list_comma, polarity_label, polarity_score, split_fields
from newsflow.operators.dedup import first_per_key
from newsflow.sources.quoted import CHUNK_LINES, MISSING, quoted_fields, quoted_records

COMMA_COLUMNS = ["themes", "locations", "persons", "organizations"]


def wide_scan_skip_bad(lines: DataFrame, column_map: dict[int, str], group_col: str,
                       order_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC-5 + PRJ-18 per archive (``group_col``): the first line sets the width; wider lines are
    dropped, narrower ones padded; blank lines skipped; NULL -> ``''``.

    ``lines`` carries its archive's ``first_width`` (the archive reader and the landing table give
    it), so each line is judged alone: no join, no shuffle of raw lines.
    """
    parts = lines.filter(F.trim(F.col("value")) != "").withColumn("__f", split_fields("value"))
    kept = parts.filter(F.size("__f") <= F.col("first_width"))
    cols = [F.when(F.lit(i) < F.col("first_width"), F.coalesce(F.get(F.col("__f"), i), F.lit("")))
            .alias(name) for i, name in column_map.items()]
    return kept.select(group_col, order_col, *keep, *cols)


def wide_scan_quoted(lines: DataFrame, column_map: dict[int, str], group_col: str, order_col: str,
                     keep: tuple[str, ...] = (), chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """SRC-5 + PRJ-18 as the legacy reader reads: quoted fields may hold separators and line ends, texts that
    mean a missing value become ``''``; the first record sets the width, wider ones are dropped.

    A record's position is its first line's. A column past the width is NULL, as in ``wide_scan_skip_bad``.
    """
    records = quoted_records(lines, group_col, order_col, keep, chunk_lines=chunk_lines)
    records = records.withColumn("__f", quoted_fields(F.col("value")))
    width = records.groupBy(group_col).agg(F.min_by(F.size("__f"), order_col).alias("__w"))
    # One row per archive is sent to the records.
    kept = records.join(F.broadcast(width), group_col).filter(F.size("__f") <= F.col("__w"))
    field = lambda i: F.coalesce(F.get(F.col("__f"), i), F.lit(""))
    cols = [F.when(F.lit(i) < F.col("__w"), F.when(field(i).isin(MISSING), F.lit("")).otherwise(field(i))).alias(name)
            for i, name in column_map.items()]
    return kept.select(group_col, order_col, *keep, *cols)


def legacy_records(rows: DataFrame, event_ts=None) -> DataFrame:
    """PRJ-11 + PRJ-7 on the scanned fields (``tone_raw`` consumed and dropped)."""
    ts = event_ts if event_ts is not None else F.unix_millis(F.current_timestamp())
    lists = {c: list_comma(c) for c in COMMA_COLUMNS if c in rows.columns}
    return (rows.withColumns({
                **lists,
                "sentiment_score": polarity_score(F.coalesce(F.col("tone_raw"), F.lit(""))),
                "sentiment_label": polarity_label(F.coalesce(F.col("tone_raw"), F.lit(""))),
                "event_ts": ts if not isinstance(ts, int) else F.lit(ts).cast("bigint"),
            }).drop("tone_raw"))


def send_new_urls(records: DataFrame, batch_col: str, order_col: str,
                  key: str = "source_url") -> DataFrame:
    """DUP-2: each URL once, at its first batch and line (what the legacy send loop emits)."""
    return first_per_key(records, [key], [batch_col, order_col])
