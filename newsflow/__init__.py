"""newsflow: news-article stream analytics as Spark DataFrame functions.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a column
function ``Column -> Column``) so it composes with ``DataFrame.transform`` and
runs unchanged in batch and in Structured Streaming.

Sub-packages
------------
functions  column-level functions (dates, tone, lists, URLs, JSON, fields)
operators  row-level operators (quality filters, dedup, text features, model store)
sources    scans (TSV, ragged text, zip archives, manifests, stream sources)
sinks      writers (keyed JSON publish, batch status, partitioned / idempotent Parquet)
plans      composite batch jobs (clean, preprocess, normalize, legacy, ingest)
streaming  the micro-batch job and stream-only operators
"""

__version__ = "0.1.0"
