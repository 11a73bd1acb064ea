"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs in DuckDB over the pre-registered driver tables and must give
the same rows, column names and types as ``newsflow.queries``. The SQL derives
results from the base tables directly (not from the raw lines the Spark side
parses), so positional parsing is checked against an independent derivation.

Dialect notes: DuckDB string literals keep backslashes (Spark's need doubling in
SQL text, not here); ``regexp_replace`` needs the ``'g'`` flag to replace all;
list indexes start at 1; DuckDB timestamps equal Spark ``timestamp_ntz``.
"""

from __future__ import annotations

from newsflow.operators.text import default_stop_words

VIEW = """
v AS (
  SELECT CAST(e.event_id AS VARCHAR) AS record_id,
         CASE WHEN e.value < 1.0 THEN 'bad' WHEN e.value > 250.0 THEN ''
              WHEN e.event_id % 31 = 0 THEN strftime(e.ts, '%Y%m%d%H')
              ELSE strftime(e.ts, '%Y%m%d%H%M%S') END AS raw_date,
         d.source AS source,
         CASE WHEN e.event_type = 'error' THEN NULL WHEN e.value < 2.0 THEN '' ELSE p.url END AS url,
         regexp_replace(d.text, '[ \\t\\n\\r]+', ';', 'g') AS themes,
         d.lang || ';;;' || upper(d.lang) AS locations,
         ' ' || coalesce(d.source, 'None') || ';;' || upper(e.event_type) || ';' AS persons,
         array_to_string(string_split_regex(coalesce(d.text, ''), '[ \t\n\r]+')[1:6], ';;') AS organizations,
         concat_ws(';', '', e.event_type, d.source, '') AS all_names,
         CASE WHEN e.value > 200.0 THEN NULL
              ELSE CAST(CAST(floor(e.value / 20) AS BIGINT) - 3 AS VARCHAR)
                   || CASE e.event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '.5' WHEN 2 THEN '.0625' ELSE '.2505' END
                   || CASE WHEN e.event_id % 23 = 0 THEN 'd' WHEN e.event_id % 29 = 0 THEN 'x' ELSE '' END
                   || ',' || CAST(e.user_id % 7 AS VARCHAR) || CASE WHEN e.event_id % 3 = 0 THEN '.0005' ELSE '' END
         END AS tone_raw,
         e.event_id AS line_no,
         'feed/' || strftime(e.ts, '%Y%m%d') || '000000.gkg.csv.zip' AS batch_url,
         CAST(date_diff('day', DATE '1970-01-01', CAST(e.ts AS DATE)) AS INTEGER) AS batch_id,
         e.event_type AS event_type
  FROM events e
  LEFT JOIN documents d ON d.doc_id = e.event_id
  LEFT JOIN pages p ON p.page_id = e.user_id
)"""

# Width of raw lines by event type (ragged inputs), as in newsflow.sources.tables.
WIDTH = ("CASE event_type WHEN 'click' THEN 27 WHEN 'view' THEN 27 WHEN 'purchase' THEN 30 "
         "WHEN 'signup' THEN 10 WHEN 'error' THEN 16 ELSE 27 END")

# The batch path reads exactly 14 digits, and takes a number with a type letter (Spark's cast does).
COMPACT = "CASE WHEN regexp_full_match(raw_date, '[0-9]{14}') THEN try_strptime(raw_date, '%Y%m%d%H%M%S') END"
BATCH_TONE = "TRY_CAST(regexp_replace(split_part(tone_raw, ',', 1), '[dDfF]$', '') AS FLOAT)"

# Parsed / cleaned columns of the batch path.
PARSED = """
parsed AS (
  SELECT record_id, source AS outlet, url,
         lower(regexp_replace(trim(themes), ';+', '|', 'g')) AS themes,
         lower(regexp_replace(trim(locations), ';+', '|', 'g')) AS locations,
         lower(regexp_replace(trim(persons), ';+', '|', 'g')) AS persons,
         lower(regexp_replace(trim(organizations), ';+', '|', 'g')) AS organizations,
         lower(regexp_replace(trim(all_names), ';+', '|', 'g')) AS all_names,
         """ + COMPACT + """ AS event_time,
         """ + BATCH_TONE + """ AS tone_score,
         regexp_extract(url, 'https?://([^/]+)', 1) AS source
  FROM v
)"""

LABEL = """CASE WHEN isnan({s}) THEN 'positive' WHEN {s} < -2.0 THEN 'negative'
                 WHEN {s} > 2.0 THEN 'positive' ELSE 'neutral' END"""

CLEAN = """
clean AS (
  SELECT *, """ + LABEL.format(s="tone_score") + """ AS sentiment_label
  FROM parsed
  WHERE url IS NOT NULL AND event_time IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY event_time, record_id) = 1
)"""

# The producer's strptime: two digits a field where they fit, one where they do not.
_FIELDS = ("'^([0-9]{4})(1[0-2]|0[1-9]|[1-9])(3[0-1]|[1-2][0-9]|0[1-9]|[1-9]| [1-9])"
           "(2[0-3]|[0-1][0-9]|[0-9])([0-5][0-9]|[0-9])(6[0-1]|[0-5][0-9]|[0-9])$'")
_PARTS = " || ".join(f"lpad(trim(regexp_extract(substr(raw_date, 1, 14), {_FIELDS}, {i})), {4 if i == 1 else 2}, '0')"
                     for i in range(1, 7))
ISO = f"""CASE WHEN regexp_matches(substr(raw_date, 1, 14), {_FIELDS})
             THEN strftime(try_strptime({_PARTS}, '%Y%m%d%H%M%S'), '%Y-%m-%dT%H:%M:%S') END"""

INGESTED = "strftime(DATE '1970-01-01' + (batch_id + 1), '%Y-%m-%d') || 'T00:00:00'"

# Producer records (JOB-4) from the view: fields as the raw line gives them ('' for NULL).
RECORDS = """
f AS (
  SELECT coalesce(record_id, '') AS record_id, coalesce(raw_date, '') AS raw_date,
         coalesce(source, '') AS source, coalesce(url, '') AS url,
         coalesce(themes, '') AS themes, coalesce(locations, '') AS locations,
         coalesce(persons, '') AS persons, coalesce(organizations, '') AS organizations,
         coalesce(all_names, '') AS all_names, coalesce(tone_raw, '') AS tone_raw,
         batch_url, batch_id
  FROM v
),
recs AS (
  SELECT record_id, """ + ISO + """ AS event_time, source, url,
         replace(themes, ';', '|') AS themes, replace(locations, ';', '|') AS locations,
         replace(persons, ';', '|') AS persons, replace(organizations, ';', '|') AS organizations,
         replace(all_names, ';', '|') AS all_names,
         CASE WHEN tone_raw <> '' THEN TRY_CAST(split_part(tone_raw, ',', 1) AS DOUBLE) END AS tone_score,
         """ + INGESTED + """ AS ingested_at,
         batch_url, batch_id,
         batch_id = min(batch_id) OVER () AS is_first_batch
  FROM f
  WHERE url <> '' AND raw_date <> ''
)"""

# Rounding on the exact binary value, ties to even: a double's digits (up to 20 after the point are exact
# in printf for the fixture's small numbers) compared with the tie as text.
_SIXTY = "printf('%.60f', abs(raw))"
_TAIL = f"substr({_SIXTY}, strpos({_SIXTY}, '.') + 4)"
_HEAD = f"CAST(replace(substr({_SIXTY}, 1, strpos({_SIXTY}, '.') + 3), '.', '') AS BIGINT)"
_TIE = "rpad('5', 57, '0')"
ROUND3 = (f"CASE WHEN raw IS NULL OR isnan(raw) OR isinf(raw) THEN raw ELSE (CASE WHEN raw < 0 THEN -1.0 ELSE 1.0 END) * "
          f"CAST({_HEAD} + CASE WHEN {_TAIL} > {_TIE} OR ({_TAIL} = {_TIE} AND {_HEAD} % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE)"
          f" / 1000.0 END")

# Ragged lines: field i of a line of width w, '' past the end.
def _rf(expr: str, idx: int) -> str:
    return f"CASE WHEN {WIDTH} > {idx} THEN coalesce({expr}, '') ELSE '' END"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _stop_list() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in default_stop_words())


def _tokens(filtered: bool) -> str:
    stop = f" AND term NOT IN ({_stop_list()})" if filtered else ""
    return f"""
tok AS (
  SELECT doc_id, term FROM (
    SELECT doc_id, unnest(string_split_regex(lower(text), '\\W+')) AS term FROM documents) t
  WHERE length(term) >= 3{stop}
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term)"""


def _manifest() -> str:
    return """
m AS (
  SELECT 'manifest/' || strftime(ts, '%Y%m%d') || '.txt' AS manifest,
         event_id AS line_no,
         CASE WHEN event_type = 'error'
              THEN CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR) || ' ' || md5(CAST(event_id AS VARCHAR))
              ELSE CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR) || ' ' || md5(CAST(event_id AS VARCHAR))
                   || ' feed/' || strftime(CAST(ts AS DATE) + 1, '%Y%m%d') || '000000.'
                   || CASE WHEN event_type = 'click' THEN 'export'
                           WHEN event_type = 'view' THEN 'mentions' ELSE 'gkg' END
                   || '.csv.zip' END AS value
  FROM events
)"""


def _stop_word_twins() -> dict[str, str]:
    """The twins that need Spark ML's stop-word list."""
    q = {}
    q["tokens_filtered"] = _with(_tokens(True)) + "SELECT doc_id, term, tf FROM tf"
    q["doc_freq"] = _with(_tokens(True)) + "SELECT term, count(*) AS df FROM tf GROUP BY term"
    q["tfidf"] = _with(_tokens(True), """
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS m FROM documents)""") + """
SELECT doc_id, term, tf, df, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf
FROM (SELECT tf.doc_id, tf.term, tf.tf, dfq.df,
             CASE WHEN dfq.df >= 2 THEN ln((n.m + 1.0) / (dfq.df + 1.0)) ELSE 0.0 END AS idf
      FROM tf JOIN dfq USING (term) CROSS JOIN n) x"""
    terms = "list_filter(string_split_regex(lower({c}), '\\W+'), lambda t: length(t) >= 3 AND t NOT IN (" + _stop_list() + "))"
    q["hashing_tf"] = f"SELECT doc_id, CAST(len({terms.format(c='text')}) AS BIGINT) AS n_terms FROM documents"
    q["preprocess_features"] = _with(VIEW, PARSED, CLEAN) + f"""
SELECT record_id, url, sentiment_label, CAST(len({terms.format(c='text')}) AS BIGINT) AS n_terms
FROM (SELECT record_id, url, sentiment_label,
             concat_ws(' ', replace(themes, '|', ' '), replace(persons, '|', ' '),
                       replace(organizations, '|', ' '), replace(all_names, '|', ' ')) AS text FROM clean) t"""
    return q


def _stop_words_known() -> bool:
    try:
        return bool(default_stop_words())
    except FileNotFoundError:
        return False


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    gkg_cols = ("record_id", "raw_date", "source", "url", "themes", "locations", "persons",
                "organizations", "tone_raw", "all_names")

    q["gkg_clean"] = _with(VIEW, PARSED, CLEAN) + """
SELECT record_id, source, url, themes, locations, persons, organizations, all_names,
       event_time, tone_score, outlet, sentiment_label FROM clean"""

    q["gkg_project"] = _with(VIEW) + "SELECT line_no, " + ", ".join(
        f"coalesce({c}, '') AS {c}" for c in gkg_cols) + " FROM v"

    idx = {"record_id": 0, "raw_date": 1, "source": 4, "url": 5, "themes": 7, "locations": 9,
           "persons": 11, "organizations": 12, "tone_raw": 15, "all_names": 23}
    q["ragged_fields"] = _with(VIEW) + "SELECT line_no, " + ", ".join(
        f"{_rf(c, idx[c])} AS {c}" for c in gkg_cols) + " FROM v"

    # Legacy map on ragged lines: 0 record_id, 4 source, 11 persons, 15 tone_raw, 23 all_names, 24 '', 25 tone_raw.
    legacy_src = {"event_date": ("record_id", 0), "source_url": ("source", 4), "themes": ("persons", 11),
                  "locations": ("tone_raw", 15), "persons": ("all_names", 23), "organizations": ("NULL", 24),
                  "tone_raw": ("tone_raw", 25)}
    wide_cols = ", ".join(
        f"CASE WHEN {i} < bw THEN {_rf(src, i)} END AS {name}" for name, (src, i) in legacy_src.items())
    wide = _with(VIEW, f"""
lw AS (SELECT *, {WIDTH} AS w FROM v),
bw AS (SELECT batch_url AS b, arg_min(w, line_no) AS bw FROM lw GROUP BY batch_url),
wide AS (SELECT lw.batch_url, lw.line_no, lw.batch_id, {wide_cols}
         FROM lw JOIN bw ON lw.batch_url = bw.b WHERE lw.w <= bw.bw)""")
    q["wide_scan_skip_bad"] = wide + """
SELECT batch_url, line_no, event_date, source_url, themes, locations, persons, organizations, tone_raw
FROM wide"""

    quoted = {
        "event_date": (0, "record_id || CASE WHEN line_no % 13 = 0 THEN '\"mid\"' ELSE '' END"),
        "source_url": (4, "coalesce(source, '') || CASE WHEN line_no % 11 = 0 THEN ' (web)' ELSE '' END"),
        "themes": (11, "CASE WHEN line_no % 5 = 0 THEN coalesce(persons, '') || chr(9) || 'q\"q\"' || chr(10) || 'next' "
                       "WHEN line_no % 7 = 0 THEN '' ELSE coalesce(persons, '') END"),
        "locations": (15, "coalesce(tone_raw, '')"),
        "persons": (23, "CASE WHEN line_no % 4 = 0 OR line_no % 9 = 0 THEN '' ELSE coalesce(all_names, '') END"),
        "organizations": (24, "CASE WHEN line_no % 3 = 0 THEN '' ELSE 'n/a too' END"),
        "tone_raw": (25, "coalesce(tone_raw, '')")}
    quoted_cols = ", ".join(f"CASE WHEN {i} >= bw THEN NULL WHEN {i} < w THEN {x} ELSE '' END AS {name}"
                            for name, (i, x) in quoted.items())
    q["wide_scan_quoted"] = _with(VIEW, f"""
lw AS (SELECT *, {WIDTH} AS w FROM v),
bw AS (SELECT batch_url AS b, arg_min(w, line_no) AS bw FROM lw GROUP BY batch_url)
""") + f"SELECT batch_url, line_no * 4 AS line_no, {quoted_cols} FROM lw JOIN bw ON batch_url = b WHERE w <= bw"

    polarity_raw = ("(TRY_CAST(split_part({t}, ',', 1) AS DOUBLE) - abs(TRY_CAST(nullif(split_part({t}, ',', 2), '') AS DOUBLE)))")
    q["legacy_records"] = wide + """,
lr AS (
  SELECT batch_url, line_no, batch_id, event_date, source_url,
         regexp_replace(lower(replace(themes, ';', ',')), '^,+|,+$', '', 'g') AS themes,
         regexp_replace(lower(replace(locations, ';', ',')), '^,+|,+$', '', 'g') AS locations,
         regexp_replace(lower(replace(persons, ';', ',')), '^,+|,+$', '', 'g') AS persons,
         regexp_replace(lower(replace(organizations, ';', ',')), '^,+|,+$', '', 'g') AS organizations,
         """ + polarity_raw.format(t="coalesce(tone_raw, '')") + """ AS raw,
         CAST(batch_id AS BIGINT) * 86400000 AS event_ts
  FROM wide
)
SELECT batch_url, line_no, batch_id, event_date, source_url, themes, locations, persons, organizations,
       coalesce(""" + ROUND3 + """, 0.0) AS sentiment_score,
       CASE WHEN raw IS NULL OR isnan(raw) THEN 'neutral' WHEN raw > 0 THEN 'positive'
            WHEN raw < 0 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
       event_ts
FROM lr
QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY batch_id, line_no) = 1"""

    q["legacy_readback"] = "SELECT source_url, themes, sentiment_label, sentiment_score, event_ts FROM (" + \
        q["legacy_records"] + ") x WHERE source_url IS NOT NULL"

    q["manifest_parse"] = _with(_manifest(), """
p3 AS (
  SELECT manifest, line_no, list_filter(string_split_regex(value, '\\s+'), lambda x: x <> '') AS parts FROM m
),
u AS (SELECT manifest, line_no, parts[3] AS url FROM p3 WHERE len(parts) = 3),
k AS (SELECT *, CASE WHEN contains(url, '.export.') THEN 'export' WHEN contains(url, '.mentions.') THEN 'mentions'
                     WHEN contains(url, '.gkg.') THEN 'gkg' END AS kind FROM u)""") + """
SELECT manifest, kind, arg_max(url, line_no) AS url FROM k WHERE kind IS NOT NULL GROUP BY manifest, kind"""

    q["manifest_first"] = _with(_manifest()) + """
SELECT manifest,
       arg_min(string_split(regexp_replace(value, '^\\s+|\\s+$', '', 'g'), ' ')[-1], line_no) AS url
FROM m WHERE contains(value, 'gkg.csv') GROUP BY manifest"""

    q["parse_compact_ts"] = _with(VIEW) + \
        f"SELECT record_id, {COMPACT} AS event_time FROM v"
    q["compact_to_iso"] = _with(VIEW) + f"SELECT record_id, {ISO} AS event_time FROM v"
    q["iso_to_ts"] = _with(VIEW) + f"""
SELECT record_id, iso, TRY_CAST(iso AS TIMESTAMP) AS event_time FROM (SELECT record_id, {ISO} AS iso FROM v)"""
    q["tone_score"] = _with(VIEW) + \
        f"SELECT record_id, {BATCH_TONE} AS tone_score FROM v"
    q["tone_label"] = _with(VIEW) + "SELECT record_id, tone_score, " + LABEL.format(s="tone_score") + \
        f" AS sentiment_label FROM (SELECT record_id, {BATCH_TONE} AS tone_score FROM v)"
    q["polarity"] = _with(VIEW) + """
SELECT record_id, coalesce(""" + ROUND3 + """, 0.0) AS sentiment_score,
       CASE WHEN raw IS NULL OR isnan(raw) THEN 'neutral' WHEN raw > 0 THEN 'positive'
            WHEN raw < 0 THEN 'negative' ELSE 'neutral' END AS sentiment_label
FROM (SELECT record_id, """ + polarity_raw.format(t="coalesce(tone_raw, '')") + """ AS raw FROM v)"""

    lists = ("themes", "locations", "persons", "organizations", "all_names")
    q["clean_list"] = _with(VIEW) + "SELECT record_id, " + ", ".join(
        f"lower(regexp_replace(trim({c}), ';+', '|', 'g')) AS {c}" for c in lists) + " FROM v"
    q["list_pipe"] = _with(VIEW) + "SELECT record_id, " + ", ".join(
        f"replace({c}, ';', '|') AS {c}" for c in lists) + " FROM v"
    q["list_comma"] = _with(VIEW) + "SELECT record_id, " + ", ".join(
        f"regexp_replace(lower(replace(coalesce({c}, ''), ';', ',')), '^,+|,+$', '', 'g') AS {c}"
        for c in lists[:4]) + " FROM v"
    q["build_text"] = _with(VIEW, PARSED) + """
SELECT record_id, concat_ws(' ', replace(themes, '|', ' '), replace(persons, '|', ' '),
                            replace(organizations, '|', ' '), replace(all_names, '|', ' ')) AS text
FROM parsed"""
    q["url_host"] = "SELECT page_id, url, regexp_extract(url, 'https?://([^/]+)', 1) AS host FROM pages"
    q["json_flatten"] = \
        "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"

    q["required_fields"] = _with(VIEW, PARSED) + """
SELECT record_id, source, url, themes, locations, persons, organizations, all_names,
       CAST(event_time AS TIMESTAMP) AS event_time, tone_score, outlet
FROM parsed WHERE url IS NOT NULL AND event_time IS NOT NULL"""
    q["required_nonempty"] = _with(VIEW) + \
        "SELECT record_id, url, raw_date FROM v WHERE coalesce(url, '') <> '' AND coalesce(raw_date, '') <> ''"
    q["reject_counts"] = _with(VIEW) + """
SELECT batch_url,
       count_if(coalesce(url, '') <> '' AND coalesce(raw_date, '') <> '') AS sent,
       count_if(NOT (coalesce(url, '') <> '' AND coalesce(raw_date, '') <> '')) AS skipped
FROM v GROUP BY batch_url"""

    dedup_in = _with(VIEW) + """
SELECT record_id, url, raw_date, source, tone_raw, """ + COMPACT + """ AS event_time
FROM v WHERE url IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY url ORDER BY event_time NULLS LAST, record_id) = 1"""
    q["dedup_url"] = dedup_in
    q["dedup_url_window"] = dedup_in
    q["dedup_cross_batch"] = _with(VIEW) + """
SELECT url, record_id, batch_id, batch_url, line_no FROM v WHERE url IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY url ORDER BY batch_id, line_no) = 1"""

    q["preprocess"] = _with(VIEW, PARSED, CLEAN) + """
SELECT record_id, url, event_time, tone_score, sentiment_label, source,
       concat_ws(' ', replace(themes, '|', ' '), replace(persons, '|', ' '),
                 replace(organizations, '|', ' '), replace(all_names, '|', ' ')) AS text
FROM clean"""
    q["preview_topn"] = _with(VIEW, PARSED, CLEAN) + """
SELECT url, event_time, tone_score, sentiment_label, source FROM clean
ORDER BY event_time, url LIMIT 20"""

    q["normalize_records"] = _with(VIEW, RECORDS) + """
SELECT record_id, event_time, source, url, themes, locations, persons, organizations, all_names,
       tone_score, ingested_at FROM recs"""
    q["batch_lineage"] = _with(VIEW, RECORDS) + \
        "SELECT record_id, batch_url, is_first_batch, batch_id FROM recs"
    status = """
status AS (
  SELECT 'batch_published' AS event, batch_url, count(*) AS record_count,
         batch_id = min(batch_id) OVER () AS is_first, """ + INGESTED + """ AS timestamp
  FROM recs GROUP BY batch_url, batch_id
)"""
    q["batch_status"] = _with(VIEW, RECORDS, status) + \
        "SELECT event, batch_url, record_count, is_first, timestamp FROM status"
    q["new_files"] = _with(VIEW, RECORDS, status, _manifest(), """
p3 AS (
  SELECT manifest, line_no, list_filter(string_split_regex(value, '\\s+'), lambda x: x <> '') AS parts FROM m
),
u AS (SELECT manifest, line_no, parts[3] AS url FROM p3 WHERE len(parts) = 3),
latest AS (SELECT manifest, arg_max(url, line_no) AS url FROM u
           WHERE NOT contains(url, '.export.') AND NOT contains(url, '.mentions.') AND contains(url, '.gkg.')
           GROUP BY manifest)""") + """
SELECT DISTINCT url AS batch_url FROM latest a
WHERE NOT EXISTS (SELECT 1 FROM status s WHERE s.batch_url = a.url)"""

    q["output_rows"] = _with(VIEW, RECORDS) + """
SELECT record_id, event_time, source, url, themes, persons, organizations, locations, tone_score,
       """ + LABEL.format(s="tone_score") + """ AS sentiment_label, batch_url, batch_id
FROM (SELECT record_id, TRY_CAST(event_time AS TIMESTAMP) AS event_time, source, url, themes, persons,
             organizations, locations, CAST(tone_score AS FLOAT) AS tone_score, batch_url, batch_id
      FROM recs) r
WHERE url IS NOT NULL AND event_time IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY batch_id, url ORDER BY event_time, record_id) = 1"""

    q["publish_json"] = _with(VIEW, RECORDS) + """
SELECT url AS key, record_id, event_time, source, url, themes, locations, persons, organizations, all_names,
       CAST(tone_score AS FLOAT) AS tone_score, ingested_at, batch_url, is_first_batch
FROM recs"""

    q["tokens"] = _with(_tokens(False)) + "SELECT doc_id, term, tf FROM tf"
    if _stop_words_known():
        q.update(_stop_word_twins())

    q["range_sum"] = """
SELECT CAST(sum(event_id) AS BIGINT) AS total, count(*) AS n, CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS expected
FROM events"""
    q["parquet_roundtrip"] = "SELECT * FROM events"

    # File-backed operators: what is read back equals what was derived from the tables.
    q["scan_gkg"] = _with(VIEW) + "SELECT " + ", ".join(
        f"nullif(coalesce({c}, ''), '') AS {c}" for c in gkg_cols) + " FROM v"
    q["zip_scan"] = _with(VIEW) + "SELECT replace(replace(batch_url, 'feed/', ''), '.zip', '') AS member, " + \
        ", ".join(f"coalesce({c}, '') AS {c}" for c in gkg_cols) + " FROM v"
    q["stream_job"] = "SELECT * EXCLUDE (batch_id) FROM (" + q["output_rows"] + ") o"
    q["stream_dedup"] = _with(VIEW, RECORDS) + \
        "SELECT DISTINCT url FROM recs WHERE url IS NOT NULL AND TRY_CAST(event_time AS TIMESTAMP) IS NOT NULL"
    q["stream_dedup_bounded"] = _with(VIEW, RECORDS) + "SELECT DISTINCT url FROM recs WHERE url IS NOT NULL"
    q["idf_refit"] = "SELECT count(*) AS n_docs, 0::BIGINT AS other_counts, 0::BIGINT AS other_weights FROM documents"
    q["stream_feed"] = q["zip_scan"]
    q["drop_seen_indexed"] = _with(VIEW, """
k AS (SELECT concat_ws('#', url, substr(raw_date, 9, 2)) AS key, batch_id FROM v WHERE url IS NOT NULL),
m AS (SELECT floor((min(batch_id) + max(batch_id)) / 2) AS middle FROM k)""") + """
SELECT DISTINCT key FROM k, m WHERE batch_id > middle
  AND key NOT IN (SELECT key FROM k, m WHERE batch_id <= middle)"""
    q["write_partitioned"] = q["output_rows"]
    q["idempotent_sink"] = q["output_rows"]
    q["logged_tables"] = "SELECT *, count(*) OVER (PARTITION BY batch_id) AS batch_rows FROM (" + q["output_rows"] + ") o"
    q["stream_rejects"] = _with(VIEW, RECORDS, """
sent AS (
  SELECT CASE WHEN CAST(record_id AS BIGINT) % 17 = 0 THEN 'malformed' WHEN url = '' THEN 'no_url'
              WHEN """ + ISO + """ IS NULL THEN 'no_time' END AS reason, record_id, batch_url
  FROM f
)""") + """
SELECT reason, CASE WHEN reason <> 'malformed' THEN batch_url END AS batch_url, count(*) AS n,
       min(CASE WHEN reason <> 'malformed' THEN record_id END) AS first_id,
       max(CASE WHEN reason <> 'malformed' THEN record_id END) AS last_id
FROM sent WHERE reason IS NOT NULL GROUP BY ALL"""
    q["stream_ingest"] = _with(VIEW, RECORDS) + """
SELECT record_id, event_time, source, url, themes, locations, persons, organizations, all_names,
       CAST(tone_score AS FLOAT) AS tone_score, ingested_at, batch_url, is_first_batch
FROM recs"""
    return q

