"""Filters and row rejection (FLT-1 .. FLT-4, AGG-1, AGG-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT-1 / FLT-4: drop rows where any of ``cols`` is NULL."""
    return df.dropna(subset=list(cols))


def nonempty(*cols: str) -> Column:
    """True when every column is neither NULL nor empty text."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return cond


def require_nonempty(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT-2: drop rows where any of ``cols`` is empty (NULL counts as empty)."""
    return df.filter(nonempty(*cols))


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """FLT-3: ``(valid_rows, rejected_rows)`` by one boolean column (NULL counts as rejected)."""
    flag = F.coalesce(valid, F.lit(False))
    return df.filter(flag), df.filter(~flag)


def reject_counts(df: DataFrame, valid: Column, by: Sequence[str] = ()) -> DataFrame:
    """AGG-3: ``sent`` and ``skipped`` counters, globally or per group (one pass, partial aggregation)."""
    flag = F.coalesce(valid, F.lit(False))
    aggs = [F.count_if(flag).alias("sent"), F.count_if(~flag).alias("skipped")]
    return df.groupBy(*by).agg(*aggs)


def observe_counts(df: DataFrame, name: str, **conds: Column):
    """AGG-1 as an ``Observation``: counts collected while ``df`` runs, no extra job.

    Returns ``(observed_df, observation)``; read ``observation.get`` after an action.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(c).alias(k) for k, c in conds.items()]
    return df.observe(obs, *metrics), obs
