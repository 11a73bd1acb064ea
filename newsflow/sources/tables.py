"""GKG-shaped inputs built from the driver tables (events, documents, pages).

The reference ships no data, so every article operator runs on a view over the
given tables (FIXTURES.md section 3). Each builder reads the whole tables and its
output grows with them; DuckDB twins of the same builders live in
``newsflow.oracle`` so both engines see identical rows.

Joins: events left join pages on ``page_id = user_id`` (the URL of an article;
users scale with the data, so URL repeats scale too) and left join documents (the
most bytes) on ``doc_id = event_id`` (every document matches one event).
Catalyst picks the join strategy; AQE turns the pages side into a broadcast
only when its measured size is under the threshold, and splits a skewed user.

Bad values are injected from data attributes, never by filtering rows:
  * ``raw_date`` is ``'bad'`` when ``value < 1`` and empty when ``value > 250``
  * ``url`` is NULL for ``event_type = 'error'`` and empty when ``value < 2``
  * ``tone_raw`` is NULL when ``value > 200``; its numbers have fractions, and some
    end in a letter (``d`` is a number to Spark's cast and none to the producers)
  * ``raw_date`` of some events has 10 digits
  * list fields hold runs of ``;``, capitals and outer blanks
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.session import shared_path
from newsflow.schemas import GKG_COLUMNS, GKG_WIDTH, LEGACY_PRODUCER_COLUMNS

# Width of each raw line by event type, for ragged-row operators (rows are never dropped here).
WIDTH_BY_EVENT_TYPE = {"click": 27, "view": 27, "purchase": 30, "signup": 10, "error": 16}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def batch_url_col(ts: Column) -> Column:
    """One feed archive per day of the event time."""
    return F.concat(F.lit("feed/"), F.date_format(ts, "yyyyMMdd"), F.lit("000000.gkg.csv.zip"))


def batch_id_col(ts: Column) -> Column:
    """Days since 1970-01-01 of the event time (a stable integer batch number)."""
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("int")


def single_spaced(text: Column) -> Column:
    """Each run of blanks, tabs and line ends as one blank; only texts that hold a run need a regular expression."""
    for c in "\t\n\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(text)


def gkg_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw GKG projection (10 named string columns) plus lineage: ``line_no``, ``batch_url``, ``batch_id``."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    # Both keys are the event's: the narrow join comes first, so texts are moved once.
    j = (e.join(p, e.user_id == p.page_id, "left")
         .join(d, e.event_id == d.doc_id, "left"))
    value = F.col("value")
    # Quarters and sixteenths are exact in binary: both engines print and parse them alike.
    whole = (F.floor(value / 20) - 3).cast("bigint").cast("string")
    part = F.when(F.col("event_id") % 4 == 0, F.lit("")).when(F.col("event_id") % 4 == 1, F.lit(".5")).when(
        F.col("event_id") % 4 == 2, F.lit(".0625")).otherwise(F.lit(".2505"))
    bad = F.when(F.col("event_id") % 23 == 0, F.lit("d")).when(F.col("event_id") % 29 == 0, F.lit("x")).otherwise(
        F.lit(""))
    tone = F.concat(whole, part, bad, F.lit(","), (F.col("user_id") % 7).cast("string"),
                    F.when(F.col("event_id") % 3 == 0, F.lit(".0005")).otherwise(F.lit("")))
    # Lists with runs of separators, capitals and blanks, from the text's words and other columns.
    spaced = single_spaced(F.col("text"))
    first_words = F.substring_index(F.coalesce(spaced, F.lit("")), " ", 6)
    names = F.concat(F.lit(" "), F.coalesce("source", F.lit("None")), F.lit(";;"), F.upper("event_type"), F.lit(";"))
    return j.select(
        F.col("event_id").cast("string").alias("record_id"),
        F.when(value < 1.0, F.lit("bad"))
         .when(value > 250.0, F.lit(""))
         .when(F.col("event_id") % 31 == 0, F.date_format("ts", "yyyyMMddHH"))
         .otherwise(F.date_format("ts", "yyyyMMddHHmmss")).alias("raw_date"),
        F.col("source").alias("source"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .when(value < 2.0, F.lit(""))
         .otherwise(F.col("url")).alias("url"),
        F.replace(spaced, F.lit(" "), F.lit(";")).alias("themes"),
        F.concat(F.col("lang"), F.lit(";;;"), F.upper("lang")).alias("locations"),
        names.alias("persons"),
        F.replace(first_words, F.lit(" "), F.lit(";;")).alias("organizations"),
        F.concat_ws(";", F.lit(""), F.col("event_type"), F.col("source"), F.lit("")).alias("all_names"),
        F.when(value > 200.0, F.lit(None).cast("string")).otherwise(tone).alias("tone_raw"),
        F.col("event_id").alias("line_no"),
        batch_url_col(F.col("ts")).alias("batch_url"),
        batch_id_col(F.col("ts")).alias("batch_id"),
        F.col("event_type").alias("event_type"),
    )


def gkg_fields(view: DataFrame, width: int = GKG_WIDTH) -> list[Column]:
    """The 27 (or more) positional fields of a raw line; NULL becomes empty text.

    Named columns go to their GKG positions; position 25 (unused by the main map,
    read as the tone by the legacy producer) repeats the tone; the rest are empty.
    """
    by_pos = {i: F.coalesce(F.col(n), F.lit("")) for i, n in GKG_COLUMNS.items()}
    tone_pos = next(i for i, n in LEGACY_PRODUCER_COLUMNS.items() if n == "tone_raw")
    by_pos[tone_pos] = F.coalesce(F.col("tone_raw"), F.lit(""))
    return [by_pos.get(i, F.lit("")) for i in range(width)]


def gkg_lines(spark: SparkSession, sf_dir: str, ragged: bool = False) -> DataFrame:
    """Raw tab-separated lines ``(line_no, batch_url, batch_id, value)``.

    ``ragged`` cuts or extends each line to ``WIDTH_BY_EVENT_TYPE`` fields.
    """
    v = gkg_view(spark, sf_dir)
    widest = max(WIDTH_BY_EVENT_TYPE.values()) if ragged else GKG_WIDTH
    fields = F.array(*gkg_fields(v, widest))
    if ragged:
        fields = F.slice(fields, 1, line_width())
    return v.select("line_no", "batch_url", "batch_id", F.array_join(fields, "\t").alias("value"))


def lines_with_width(spark: SparkSession, sf_dir: str, ragged: bool = False) -> DataFrame:
    """The raw lines with ``first_width``, the number of fields of the batch's first line.

    The view's joins keep every event, so the first line of a batch is its first event. One row per batch is sent
    to the lines, which stay where the last join leaves them.
    """
    e = read_table(spark, sf_dir, "events").select(
        batch_url_col(F.col("ts")).alias("batch_url"), F.col("event_id").alias("line_no"), "event_type")
    width = line_width() if ragged else F.lit(GKG_WIDTH)
    first = e.groupBy("batch_url").agg(F.min_by(width, F.col("line_no")).alias("first_width"))
    return gkg_lines(spark, sf_dir, ragged).join(F.broadcast(first), "batch_url")


def landed_lines(spark: SparkSession, sf_dir: str, ragged: bool = False) -> DataFrame:
    """The raw lines as a landing table (SNK-6 layout): ``(line_no, batch_url, batch_id, first_width, value)``.

    Producer-side operators read raw lines from storage in production; the table is
    written once per session and input. ``first_width`` is the number of fields of
    the batch's first line, as the archive reader gives it.
    """
    return _landed(spark, (sf_dir, ragged), lambda: lines_with_width(spark, sf_dir, ragged))


def _landed(spark: SparkSession, what: tuple, made) -> DataFrame:
    """A table written once per session for each ``what``."""
    key = (spark.sparkContext.applicationId, *what)
    if key not in _LANDED:
        path = shared_path(spark, "landing")
        made().write.mode("overwrite").parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


_LANDED: dict[tuple, str] = {}


def line_width() -> Column:
    """Fields of a ragged line, by event type."""
    return F.coalesce(*[F.when(F.col("event_type") == k, F.lit(w)) for k, w in WIDTH_BY_EVENT_TYPE.items()],
                      F.lit(GKG_WIDTH))


def quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines ``(line_no, batch_url, batch_id, value)`` with quoted fields, some over two lines, and missing-value texts.

    Every event is one record of its event type's width; its lines are numbered from four times its id. Their
    reader goes over them several times, so they are written once per session, as ``landed_lines``.
    """
    return _landed(spark, (sf_dir, "quoted"), lambda: _quoted_lines(spark, sf_dir))


def _quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = gkg_view(spark, sf_dir)
    fields = gkg_fields(v, max(WIDTH_BY_EVENT_TYPE.values()))
    n, quote = F.col("line_no"), lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    fields[0] = F.when(n % 13 == 0, F.concat(fields[0], F.lit('"mid"'))).otherwise(fields[0])
    fields[4] = F.when(n % 11 == 0, F.concat(quote(fields[4]), F.lit(" (web)"))).otherwise(fields[4])
    fields[11] = (F.when(n % 5 == 0, quote(F.concat(fields[11], F.lit('\tq"q"\nnext')))).when(n % 7 == 0, F.lit("NA"))
                  .otherwise(fields[11]))
    fields[23] = F.when(n % 4 == 0, F.lit('""')).when(n % 9 == 0, F.lit('"N/A"')).otherwise(fields[23])
    fields[24] = F.when(n % 3 == 0, F.lit("null")).otherwise(F.lit("n/a too"))
    value = F.array_join(F.slice(F.array(*fields), 1, line_width()), "\t")
    lines = v.select("line_no", "batch_url", "batch_id", F.posexplode(F.split(value, "\n", -1)).alias("__i", "value"))
    return lines.select((F.col("line_no") * 4 + F.col("__i")).alias("line_no"), "batch_url", "batch_id", "value")


MANIFEST_KINDS = ("export", "mentions", "gkg")


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed manifests, one per day: ``(manifest, line_no, value)``.

    Each event gives a line ``<size> <checksum> <url>`` announcing the next day's
    archive; the kind follows the event type (click: export, view: mentions,
    purchase/signup: gkg); error events give a two-part line without a URL.
    """
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    kind = (F.when(F.col("event_type") == "click", F.lit("export"))
            .when(F.col("event_type") == "view", F.lit("mentions"))
            .otherwise(F.lit("gkg")))
    url = F.concat(F.lit("feed/"), F.date_format(F.date_add(F.to_date("ts"), 1), "yyyyMMdd"),
                   F.lit("000000."), kind, F.lit(".csv.zip"))
    size = F.floor(F.col("value") * 1000).cast("bigint").cast("string")
    checksum = F.md5(F.col("event_id").cast("string"))
    line = F.when(F.col("event_type") == "error", F.concat_ws(" ", size, checksum)) \
            .otherwise(F.concat_ws(" ", size, checksum, url))
    return e.select(
        F.concat(F.lit("manifest/"), F.date_format("ts", "yyyyMMdd"), F.lit(".txt")).alias("manifest"),
        F.col("event_id").alias("line_no"),
        line.alias("value"),
    )
