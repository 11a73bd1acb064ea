"""Compact GKG dates (PRJ-1, PRJ-2, PRJ-3).

Spark 4 runs with ANSI mode on, where ``to_timestamp`` throws on a bad value and
one bad row fails the job. The ``try_`` forms give NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.schemas import COMPACT_TS_FORMAT, ISO_TS_FORMAT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_compact_ts(c, ntz: bool = True) -> Column:
    """PRJ-1: ``yyyyMMddHHmmss`` text -> timestamp; anything else -> NULL.

    ``ntz`` returns ``timestamp_ntz`` (the text has no zone); pass False for a
    session-zone ``timestamp`` (needed by ``withWatermark``).
    """
    ts = F.try_to_timestamp(_col(c).cast("string"), F.lit(COMPACT_TS_FORMAT))
    return ts.cast("timestamp_ntz") if ntz else ts


#: The field widths that a strptime of ``%Y%m%d%H%M%S`` tries, longest first.
COMPACT_FIELDS = (r"^([0-9]{4})(1[0-2]|0[1-9]|[1-9])(3[0-1]|[1-2][0-9]|0[1-9]|[1-9]| [1-9])"
                  r"(2[0-3]|[0-1][0-9]|[0-9])([0-5][0-9]|[0-9])(6[0-1]|[0-5][0-9]|[0-9])$")


def compact_to_iso(c, strict: bool = False) -> Column:
    """PRJ-2 (producer form): first 14 characters parsed, ISO text out, NULL on failure.

    A shorter digit run is read as the producer's ``strptime`` reads it (``2026051712`` is
    2026-05-01T07:01:02); with ``strict`` the text must start with 14 digits.
    """
    s = _col(c).cast("string")
    head = F.substring(s, 1, 14)
    if strict:
        full = F.when(s.rlike(r"^[0-9]{14}"), head)
    else:
        fields = [F.lpad(F.trim(F.regexp_extract(head, COMPACT_FIELDS, i)), 4 if i == 1 else 2, "0")
                  for i in range(1, 7)]
        # 14 digits can only be read as they stand; the fields are picked out of the rest.
        full = F.when(head.rlike("^[0-9]{14}$"), head).when(head.rlike(COMPACT_FIELDS), F.concat(*fields))
    return F.date_format(F.try_to_timestamp(full, F.lit(COMPACT_TS_FORMAT)), ISO_TS_FORMAT)


def iso_to_ts(c, ntz: bool = True) -> Column:
    """PRJ-3: ISO text (after the JSON hop) -> timestamp, NULL when unparseable."""
    ts = F.try_to_timestamp(_col(c).cast("string"))
    return ts.cast("timestamp_ntz") if ntz else ts
