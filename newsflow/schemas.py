"""Schemas, column maps and constants.

Fixed values (must equal the reference's for equal results):
  * raw article file: tab-separated, no header, no quoting, 27 positional fields
  * main column map (index -> name): 0 record_id, 1 raw_date, 4 source, 5 url,
    7 themes, 9 locations, 11 persons, 12 organizations, 15 tone_raw, 23 all_names
  * legacy producer column map (index -> name): 0 event_date, 4 source_url,
    11 themes, 15 locations, 23 persons, 24 organizations, 25 tone_raw
  * compact date format yyyyMMddHHmmss; ISO output yyyy-MM-dd'T'HH:mm:ss
  * tone label thresholds: below -2.0 negative, above 2.0 positive, else neutral
  * list delimiters: ';' raw, '|' cleaned, ',' legacy
  * host pattern https?://([^/]+)
  * tokenizer pattern \\W+, minimum token length 3, 10,000 hashed features,
    minimum document frequency 2
  * stream: 50,000 records per trigger, 60 s trigger; status event name "batch_published"
"""

from __future__ import annotations

from pyspark.sql import types as T

GKG_WIDTH = 27

# Main column map (field index -> name).
GKG_COLUMNS: dict[int, str] = {
    0: "record_id",
    1: "raw_date",
    4: "source",
    5: "url",
    7: "themes",
    9: "locations",
    11: "persons",
    12: "organizations",
    15: "tone_raw",
    23: "all_names",
}

# The legacy producer's column map. It does not fit GKG data
# (there 11 is persons and 15 the tone), so it is never a default: pass it on purpose.
LEGACY_PRODUCER_COLUMNS: dict[int, str] = {
    0: "event_date",
    4: "source_url",
    11: "themes",
    15: "locations",
    23: "persons",
    24: "organizations",
    25: "tone_raw",
}

# The legacy names placed on the GKG positions they were meant to read.
LEGACY_NAMES_ON_GKG: dict[int, str] = {
    1: "event_date",
    5: "source_url",
    7: "themes",
    9: "locations",
    11: "persons",
    12: "organizations",
    15: "tone_raw",
}

LIST_COLUMNS = ["themes", "locations", "persons", "organizations", "all_names"]
TEXT_COLUMNS = ["themes", "persons", "organizations", "all_names"]

COMPACT_TS_FORMAT = "yyyyMMddHHmmss"
ISO_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
HOST_PATTERN = r"https?://([^/]+)"

NEGATIVE_BELOW = -2.0
POSITIVE_ABOVE = 2.0
LABELS = ("negative", "neutral", "positive")

TOKEN_PATTERN = r"\W+"
MIN_TOKEN_LENGTH = 3
NUM_FEATURES = 10_000
MIN_DOC_FREQ = 2

MAX_RECORDS_PER_TRIGGER = 50_000
TRIGGER_INTERVAL = "60 seconds"
STATUS_EVENT = "batch_published"
STATUS_KEY = "status"


def raw_gkg_schema(width: int = GKG_WIDTH) -> T.StructType:
    """All-string positional schema ``_c0 .. _c{width-1}`` for the TSV reader."""
    return T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(width)])


# Wire record published per article (JSON value of the keyed message).
WIRE_SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType(), True),
    T.StructField("event_time", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("themes", T.StringType(), True),
    T.StructField("locations", T.StringType(), True),
    T.StructField("persons", T.StringType(), True),
    T.StructField("organizations", T.StringType(), True),
    T.StructField("all_names", T.StringType(), True),
    T.StructField("tone_score", T.FloatType(), True),
    T.StructField("ingested_at", T.StringType(), True),
    T.StructField("batch_url", T.StringType(), True),
    T.StructField("is_first_batch", T.BooleanType(), True),
])

# Columns of the stream job's output table, in order.
OUTPUT_COLUMNS = [
    "record_id", "event_time", "source", "url", "themes", "persons", "organizations",
    "locations", "tone_score", "sentiment_label", "batch_url", "batch_id",
]

STATUS_SCHEMA = T.StructType([
    T.StructField("event", T.StringType(), True),
    T.StructField("batch_url", T.StringType(), True),
    T.StructField("record_count", T.LongType(), True),
    T.StructField("is_first", T.BooleanType(), True),
    T.StructField("timestamp", T.StringType(), True),
])

# Reader schema of the legacy message (the five fields read back).
LEGACY_READ_SCHEMA = T.StructType([
    T.StructField("source_url", T.StringType(), True),
    T.StructField("themes", T.StringType(), True),
    T.StructField("sentiment_label", T.StringType(), True),
    T.StructField("sentiment_score", T.DoubleType(), True),
    T.StructField("event_ts", T.LongType(), True),
])
