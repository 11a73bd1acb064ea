"""Cutting lineage: ``materialize`` writes an intermediate once for several readers.

Join strategies are left to the planner: AQE broadcasts a side by its measured
bytes and splits skewed partitions of the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (later stages and a lost executor read the files, not the
    plan again) and lets one expensive intermediate feed several branches.
    """
    from newsflow.session import shared_path
    path = shared_path(df.sparkSession, "materialized", name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
