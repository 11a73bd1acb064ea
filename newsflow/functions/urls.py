"""URL host (PRJ-8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.schemas import HOST_PATTERN


def url_host(c) -> Column:
    """Group 1 of ``https?://([^/]+)``; no match gives ``''``, NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(c, HOST_PATTERN, 1)
