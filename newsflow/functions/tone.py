"""Tone score and sentiment labels (PRJ-4, PRJ-10, PRJ-11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.schemas import NEGATIVE_BELOW, POSITIVE_ABOVE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tone_score(c, dtype: str = "float") -> Column:
    """PRJ-4: first comma-separated value of the tone field; bad or missing -> NULL."""
    return F.get(F.split(_col(c), ","), 0).try_cast(dtype)


#: The number forms that the producers' parser accepts.
NUMBER = r"^\s*[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?\s*$"
SPECIAL = r"(?i)^\s*([+-]?inf(inity)?|[+-]?nan)\s*$"


def producer_number(c) -> Column:
    """A number as the producers parse one: ``1.5``, ``1_000``, ``inf``; not ``1.5d``, ``1.5f``; else NULL."""
    s = _col(c)
    special = F.lower(F.regexp_replace(F.trim(s), r"(?i)^[+-](nan)$", "$1"))
    return (F.when(s.rlike(NUMBER), F.trim(F.replace(s, F.lit("_"), F.lit(""))).try_cast("double"))
            .when(s.rlike(SPECIAL), special.try_cast("double")))


def producer_tone_score(c) -> Column:
    """PRJ-4 in the producer: first comma-separated value as ``producer_number``."""
    return producer_number(F.get(F.split(_col(c), ","), 0))


def tone_label(score, nan_label: str = "positive") -> Column:
    """PRJ-10: strict thresholds; exactly +-2.0 and NULL are neutral.

    NaN is decided explicitly. Spark orders NaN above every number, so the
    threshold rule alone labels it positive; that is the default here too.
    """
    s = _col(score)
    return (
        F.when(F.isnan(s), F.lit(nan_label))
        .when(s < NEGATIVE_BELOW, F.lit("negative"))
        .when(s > POSITIVE_ABOVE, F.lit("positive"))
        .otherwise(F.lit("neutral"))
    )


def _polarity_raw(c) -> Column:
    parts = F.split(_col(c), ",")
    return producer_number(F.get(parts, 0)) - F.abs(producer_number(F.get(parts, 1)))


def round_exact(value: Column, digits: int = 3) -> Column:
    """``value`` rounded on its exact binary value, ties to even (Python's ``round``).

    ``F.round`` rounds the shortest decimal text: 1.0005 (below the tie in binary) goes up
    there. The number is split into two halves whose products with ``10 ** digits`` are
    exact, so the comparison with the tie is exact too. From ``2 ** 53 / 10 ** digits`` on, neighbouring
    doubles lie so far apart that rounding changes nothing.
    """
    scale = float(10 ** digits)
    a = F.abs(value)
    c = a * 134217729.0
    high = c - (c - a)
    low = a - high
    q = F.floor(a * scale).cast("double")
    over = ((high * scale - q) - 0.5) + low * scale
    up = (over > 0) | ((over == 0) & (q % 2.0 == 1.0))
    rounded = (q + F.when(up, 1.0).otherwise(0.0)) / scale
    return F.when((a < 2.0 ** 53 / scale) & ~F.isnan(value), F.when(value < 0, -rounded).otherwise(rounded)).otherwise(value)


def polarity_score(c, digits: int = 3) -> Column:
    """PRJ-11 (legacy): ``first - |second|`` rounded; any parse failure -> 0.0."""
    return F.coalesce(round_exact(_polarity_raw(c), digits), F.lit(0.0))


def polarity_label(c) -> Column:
    """PRJ-11 (legacy): sign of the *unrounded* score; failure and NaN -> neutral."""
    raw = _polarity_raw(c)
    return (
        F.when(raw.isNull() | F.isnan(raw), F.lit("neutral"))
        .when(raw > 0, F.lit("positive"))
        .when(raw < 0, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )
