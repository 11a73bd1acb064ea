"""Deduplication (DUP-1, DUP-2, DUP-3).

The reference keeps an arbitrary row per key (``dropDuplicates`` plans a
``first()`` after a shuffle). Here the survivor is fixed by an explicit total
order, so reruns and replays give the same rows.

Both forms are ``row_number() = 1``, which Spark plans with a partial
``WindowGroupLimit`` before the shuffle: a key that holds a third of all rows
sends one row per map task. Only the key and the narrow order columns are
compared; wide columns ride along. (A ``min`` over a struct of all columns
would compare and copy whole rows, raw text included, and cannot hold a map.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def _has_map(kind) -> bool:
    if isinstance(kind, ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType)


def row_digest(df: DataFrame) -> Column:
    """A 64-bit hash of the row's columns (those that hold a map excepted)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  nulls_last: bool = True) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (NULL order values last by default); rows
    that tie on ``order`` are told apart by a hash of their columns."""
    tied = df.withColumn("__tie", row_digest(df))
    return first_per_key_window(tied, keys, [*order, "__tie"], nulls_last).drop("__tie")


def first_per_key_window(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                         nulls_last: bool = True) -> DataFrame:
    """The same for an ``order`` that is total."""
    sort = [F.col(o).asc_nulls_last() if nulls_last else F.col(o).asc_nulls_first() for o in order]
    w = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def drop_seen(new_rows: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DUP-2 / DUP-3 (batch form): rows whose key is not in ``seen`` (a ``left_anti`` join).

    ``seen`` is reduced to distinct keys first (partial aggregation), so the join's
    build side is one row per key; AQE broadcasts it when its measured size allows.
    """
    keys = list(keys)
    return new_rows.join(seen.select(*keys).distinct(), on=keys, how="left_anti")


def first_across_batches(df: DataFrame, key: str, batch_col: str, position_col: str) -> DataFrame:
    """DUP-2 over a whole history: each key once, at its first batch and position.

    Equals running ``drop_seen`` batch after batch (and deduplicating inside each batch),
    in one aggregation instead of a join per batch.
    """
    return first_per_key(df, [key], [batch_col, position_col])
