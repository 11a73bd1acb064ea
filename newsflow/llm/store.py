"""Written intermediates and worker-side caches shared by the operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from newsflow.session import shared_path
from newsflow.sinks.parquet import delete_path


def stored(df: DataFrame, name: str, compression: str | None = None, bucket: tuple[int, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back (cuts the lineage).

    ``bucket``: ``(files, column)`` of a bucketed, sorted table, whose grouping by that column needs no shuffle.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    if bucket:
        table = f"newsflow_{name}_{path.rsplit('/', 1)[-1]}"
        (df.write.bucketBy(*bucket).sortBy(bucket[1]).option("path", path).option("compression", compression or "snappy")
         .format("parquet").saveAsTable(table))
        return spark.table(table)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that no later step reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def width(spark: SparkSession) -> int:
    """The session's shuffle width (``spark.sql.shuffle.partitions``)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def narrow_batches(spark: SparkSession, size: str = "8m"):
    """Arrow batches of about ``size`` in the jobs that run inside, for tables whose rows are large.

    A batch is held outside the heap, with room to grow, and a second time as the worker's message: at Spark's own 64 MB
    that is some hundred MB for each running task.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def worker_cache(key, make):
    """A value built once per Python worker process and reused by its later tasks.

    One value at a time: another operator's memo would only take memory from this one.
    """
    import sys
    import types
    cache = sys.modules.setdefault("newsflow_worker_cache", types.ModuleType("newsflow_worker_cache")).__dict__
    values = cache.setdefault("values", {})
    if key not in values:
        values.clear()
        values[key] = make()
    return values[key]
