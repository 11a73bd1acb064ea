"""Column functions: each takes and returns ``Column`` objects built from ``pyspark.sql.functions``.

All of them stay inside whole-stage codegen (no Python UDF).
"""

from newsflow.functions.dates import compact_to_iso, iso_to_ts, parse_compact_ts
from newsflow.functions.fields import field_at, split_fields
from newsflow.functions.lists import build_text, clean_list, list_comma, list_pipe
from newsflow.functions.tone import (
    polarity_label, polarity_score, producer_tone_score, tone_label, tone_score,
)
from newsflow.functions.urls import url_host

__all__ = [
    "build_text", "clean_list", "compact_to_iso", "field_at", "iso_to_ts", "list_comma",
    "list_pipe", "parse_compact_ts", "polarity_label", "polarity_score", "producer_tone_score",
    "split_fields", "tone_label", "tone_score", "url_host",
]
