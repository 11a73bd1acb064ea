"""Feed manifests (SRC-7, SRC-8, FLT-6).

A manifest is text: lines of ``<size> <checksum> <url>``. Many manifests (one per
poll) are parsed at once; each result is grouped by the manifest it came from,
with the line position as the order (``max_by`` / ``min_by``: partial aggregation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KIND_MARKERS = (("export", ".export."), ("mentions", ".mentions."), ("gkg", ".gkg."))


def read_manifests(spark, path: str) -> DataFrame:
    """``(manifest, line_no, value)`` from text files; ``line_no`` orders lines inside a file."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("manifest"), "value")
    # Lines of one file stay in order inside their split; the id keeps that order.
    return raw.withColumn("line_no", F.monotonically_increasing_id())


def url_kind(url) -> F.Column:
    """Kind of an archive URL by marker; the first marker that matches wins."""
    url = F.col(url) if isinstance(url, str) else url
    out = None
    for kind, marker in KIND_MARKERS:
        out = (F.when(url.contains(marker), F.lit(kind)) if out is None
               else out.when(url.contains(marker), F.lit(kind)))
    return out


def latest_urls(lines: DataFrame, manifest_col: str, order_col: str) -> DataFrame:
    """SRC-7: keep 3-part lines, classify the URL, the last line per kind wins.

    Returns ``(manifest, kind, url)``.
    """
    parts = F.filter(F.split(F.col("value"), r"\s+"), lambda p: p != "")
    three = (lines.select(manifest_col, order_col, parts.alias("__p"))
             .filter(F.size("__p") == 3)
             .select(manifest_col, order_col, F.get(F.col("__p"), 2).alias("url")))
    typed = three.withColumn("kind", url_kind("url")).filter(F.col("kind").isNotNull())
    return typed.groupBy(manifest_col, "kind").agg(F.max_by("url", order_col).alias("url"))


def first_gkg_url(lines: DataFrame, manifest_col: str, order_col: str,
                  marker: str = "gkg.csv") -> DataFrame:
    """SRC-8 (legacy): the first line containing ``marker``; its last space-separated token.

    A manifest without such a line gives no row (the legacy code raised an error).
    """
    stripped = F.regexp_replace(F.col("value"), r"^\s+|\s+$", "")
    hits = (lines.filter(F.col("value").contains(marker))
            .select(manifest_col, order_col, F.element_at(F.split(stripped, " "), -1).alias("url")))
    return hits.groupBy(manifest_col).agg(F.min_by("url", order_col).alias("url"))
