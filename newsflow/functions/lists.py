"""Multi-valued fields kept as delimited strings (PRJ-5, PRJ-6, PRJ-7, PRJ-9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_list(c) -> Column:
    """PRJ-5 (batch form): trim spaces, collapse ``;`` runs to one ``|``, lowercase."""
    return F.lower(F.regexp_replace(F.trim(_col(c)), ";+", "|"))


def list_pipe(c) -> Column:
    """PRJ-6 (producer form): each ``;`` becomes ``|``; case and runs kept."""
    return F.replace(_col(c), F.lit(";"), F.lit("|"))


def list_comma(c) -> Column:
    """PRJ-7 (legacy form): ``;`` -> ``,``, lowercase, strip leading/trailing commas."""
    return F.regexp_replace(F.lower(F.translate(_col(c), ";", ",")), r"^,+|,+$", "")


def build_text(*cols) -> Column:
    """PRJ-9: the list columns with ``|`` turned into spaces, joined by one space.

    NULL inputs are skipped, so the result is never NULL (the tokenizer needs that).
    """
    return F.concat_ws(" ", *[F.translate(_col(c), "|", " ") for c in cols])
