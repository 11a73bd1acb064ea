"""Parquet sinks (SNK-4, SNK-5, SNK-6, STR-5).

Plain ``append`` per micro-batch is at-least-once: a batch replayed after a
failure is written twice. ``write_batch`` makes the write idempotent: the
batch's own directory (``run=<run>/batch_id=<n>``) is replaced, so a replay of
the same offsets leaves exactly one copy, and a batch with no valid row still
clears what an earlier attempt wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.dedup import row_digest
from newsflow.session import shared_path


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete through the Hadoop file system of ``path`` (HDFS, S3, local)."""
    p, fs = _hadoop_path(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] = ("sentiment_label",),
                      mode: str = "append", files_per_partition: int | None = None) -> None:
    """SNK-4: Parquet partitioned by ``partition_cols``.

    ``files_per_partition`` clusters rows by the partition columns plus a hash
    salt of ``files_per_partition`` values, so each partition value is written by
    at most that many tasks (few files, against the small-files problem of
    per-batch appends) while a hot value (one label can hold most rows) is still
    spread over that many tasks instead of one.
    """
    out = df
    if files_per_partition:
        salt = F.pmod(row_digest(df), F.lit(files_per_partition))
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = df.repartition(width, *partition_cols, salt)
    out.write.mode(mode).partitionBy(*partition_cols).parquet(path)


def few_files(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows clustered by ``cols`` into tasks of the advisory size (AQE rebalance).

    The number of files follows the bytes: small partition values share one task and get
    one file each, a value that holds most of the rows is split over many tasks.
    """
    return df.hint("rebalance", *[F.col(c) for c in cols])


def write_batch(df: DataFrame, path: str, batch_id: int, run: str,
                partition_cols: Sequence[str] = ("sentiment_label",), clustered: bool = True) -> None:
    """STR-5: idempotent write of one micro-batch under ``run=<run>/batch_id=<batch_id>``.

    ``clustered=False`` writes the rows where they are, without a shuffle (more files).
    """
    spark = df.sparkSession
    delete_path(spark, f"{path.rstrip('/')}/run={run}/batch_id={batch_id}")
    out = (df.drop("run", "batch_id")
             .selectExpr("*", f"'{run}' AS run", f"CAST({int(batch_id)} AS INT) AS batch_id"))
    out = few_files(out, partition_cols) if clustered else out
    out.write.mode("append").partitionBy("run", "batch_id", *partition_cols).parquet(path)


def write_batches(df: DataFrame, path: str, run: str, batch_col: str = "batch_id",
                  partition_cols: Sequence[str] = ("sentiment_label",)) -> None:
    """STR-5 for many batches in one job: dynamic partition overwrite of ``run/batch_id/...``.

    Only the partitions present in ``df`` are replaced, so writing the same batches
    again (a replay) leaves one copy of each. Each partition gets few files (``few_files``).
    """
    out = df.withColumn("run", F.lit(run)).withColumn(batch_col, F.col(batch_col).cast("int"))
    keys = ["run", batch_col, *partition_cols]
    (few_files(out, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(path))


def compact(spark: SparkSession, path: str, run: str, batch_col: str = "batch_id") -> None:
    """R7: rewrite one run's output with few files per partition.

    The run is first copied to the shared folder (a path cannot be overwritten
    while it is read), then its partitions are replaced by dynamic overwrite;
    other runs and partitions are untouched.
    """
    from newsflow.operators.joins import materialize
    staged = materialize(read_output(spark, path, run).drop("run"), "compact")
    write_batches(staged, path, run, batch_col)


def read_output(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """Read an output table; ``run`` prunes to one run's partitions."""
    df = spark.read.parquet(path)
    return df.filter(F.col("run") == run) if run is not None else df


def roundtrip(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """SNK-5 + SRC-12: overwrite as Parquet in the shared folder, read it back."""
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def land_raw(lines: DataFrame, path: str, partition_col: str = "batch_url") -> None:
    """SNK-6: keep the raw lines of each archive in a landing table (Parquet, replaced per archive)."""
    (lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
