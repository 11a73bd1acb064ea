"""GKG raw files: TSV scan (SRC-1, SRC-2), raw text lines (SRC-3, SRC-4).

The TSV reader always gets an explicit positional schema: inferring the width
from the first line breaks on a short first line. Catalyst prunes the read to
the selected fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.schemas import GKG_COLUMNS, GKG_WIDTH, raw_gkg_schema


def read_gkg(spark: SparkSession, path: str, column_map: dict[int, str] = GKG_COLUMNS,
             width: int = GKG_WIDTH, with_file: bool = False) -> DataFrame:
    """SRC-1 + SRC-2: tab-separated, no header, no quoting, single-line records -> named fields.

    Empty fields read as NULL; ``"`` stays literal; blank lines are skipped.
    ``with_file`` adds ``batch_file`` (the source file, for lineage).
    """
    raw = (spark.read.schema(raw_gkg_schema(width))
           .option("sep", "\t").option("quote", "").option("header", "false")
           .option("multiLine", "false").option("mode", "PERMISSIVE")
           .csv(path))
    cols = [F.col(f"_c{i}").alias(name) for i, name in column_map.items()]
    if with_file:
        cols.append(F.col("_metadata.file_path").alias("batch_file"))
    return raw.select(*cols)


def read_lines(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """SRC-4: raw lines as text (invalid UTF-8 -> U+FFFD), for ragged-safe parsing (SRC-3)."""
    df = spark.read.text(path)
    if with_file:
        return df.select(F.col("_metadata.file_path").alias("batch_file"), "value")
    return df


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a ``value`` column as text files (fixtures, landing copies)."""
    lines.select("value").write.mode(mode).text(path)
