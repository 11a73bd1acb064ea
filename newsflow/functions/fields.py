"""Positional fields of raw text lines (SRC-2, SRC-3, PRJ-18)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_fields(line, sep: str = "\t") -> Column:
    """All fields of a line, keeping empty trailing ones (limit -1)."""
    line = F.col(line) if isinstance(line, str) else line
    return F.split(line, sep, -1)


def field_at(fields: Column, index: int, missing: str | None = "") -> Column:
    """Field ``index`` of an array, ``missing`` when the row is too short (``F.get`` never throws)."""
    value = F.get(fields, index)
    return value if missing is None else F.coalesce(value, F.lit(missing))

