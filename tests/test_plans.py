"""Plan shape checks: the properties the design relies on at scale."""

import os

from pyspark.sql import functions as F

from newsflow.operators.dedup import first_per_key, first_per_key_window
from newsflow.operators.text import term_counts, tfidf, tokenize
from newsflow.sinks.parquet import write_partitioned
from newsflow.sources.gkg import read_gkg

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_key_rows(spark):
    # one URL holds a third of all rows
    rows = [("hot" if i % 3 == 0 else f"u{i}", i, str(i)) for i in range(3000)]
    return spark.createDataFrame(rows, "url string, t long, record_id string")


def test_dedup_is_partial_before_shuffle(spark):
    df = first_per_key(hot_key_rows(spark), ["url"], ["t", "record_id"])
    p = plan(df)
    # One row per key and task leaves the map side.
    assert "WindowGroupLimit" in p and p.index("Exchange") < p.rindex("WindowGroupLimit")
    got = {r.url: r.t for r in df.collect()}
    assert got["hot"] == 0 and len(got) == 2001


def test_window_form_limits_before_shuffle(spark):
    p = plan(first_per_key_window(hot_key_rows(spark), ["url"], ["t", "record_id"]))
    assert "WindowGroupLimit" in p


def test_term_counts_have_no_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", tokenize("text").alias("t"))
    assert "Exchange" not in plan(term_counts(docs, "doc_id", "t"))


def test_tfidf_counts_terms_once_and_leaves_the_join_to_the_planner(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", tokenize("text").alias("t"))
    p = plan(tfidf(docs, "doc_id", "t"))
    final = p.split("== Initial Plan ==")[0]
    assert final.count("keys=[term") == 2  # one aggregation, partial and final
    assert "rightHint" not in p and "leftHint" not in p


def test_wide_scan_shuffles_no_lines(spark):
    from newsflow.plans.legacy import wide_scan_skip_bad
    from newsflow.schemas import LEGACY_PRODUCER_COLUMNS
    from newsflow.sources.tables import landed_lines
    lines = landed_lines(spark, SF, ragged=True)
    p = plan(wide_scan_skip_bad(lines, LEGACY_PRODUCER_COLUMNS, "batch_url", "line_no"))
    assert "Exchange" not in p and "Join" not in p


def test_dedup_takes_map_columns_and_settles_ties(spark):
    rows = [("u", 1, {"a": i}, str(i)) for i in range(20)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "url string, t long, m map<string,int>, s string")
        got = first_per_key(df, ["url"], ["t"]).collect()
        assert len(got) == 1
        rows_kept = {r.s for r in got} if order is rows else rows_kept | {r.s for r in got}
    assert len(rows_kept) == 1


def test_batch_writes_follow_the_bytes(spark, scratch):
    """Many tasks, few rows: one file per label and batch."""
    from newsflow.sinks.parquet import write_batch, write_batches
    df = spark.range(0, 3000, 1, 16).select(
        F.col("id").cast("string").alias("record_id"), (F.col("id") % 2).cast("int").alias("batch_id"),
        F.when(F.col("id") % 10 < 2, "positive").otherwise("neutral").alias("sentiment_label"))
    one, many = os.path.join(scratch, "one"), os.path.join(scratch, "many")
    write_batch(df, one, 0, "r")
    write_batches(df, many, "r")
    count = lambda top: sum(f.endswith(".parquet") for _, _, names in os.walk(top) for f in names)
    assert count(one) == 2 and count(many) == 4


def test_tsv_scan_prunes_columns(spark, scratch):
    with open(os.path.join(scratch, "a.csv"), "w") as fh:
        fh.write("\t".join(str(i) for i in range(27)) + "\n")
    p = plan(read_gkg(spark, scratch).select("url"))
    assert "ReadSchema: struct<_c5:string>" in p


def test_parquet_filter_pushed(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").filter(F.col("event_type") == "error").select("event_id")
    p = plan(ev)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in p
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in p


def test_salted_partitioned_write_spreads_hot_label(spark, scratch):
    df = spark.range(3000).select(F.col("id").cast("string").alias("record_id"),
                                  F.when(F.col("id") % 10 == 0, "positive").otherwise("neutral").alias("sentiment_label"))
    path = os.path.join(scratch, "p")
    write_partitioned(df, path, mode="overwrite", files_per_partition=4)
    files = [f for f in os.listdir(os.path.join(path, "sentiment_label=neutral")) if f.endswith(".parquet")]
    assert 1 < len(files) <= 4  # the hot label is written by several tasks, but few files
    assert spark.read.parquet(path).count() == 3000


def test_texts_are_moved_once_on_the_way_to_the_landing_table(spark):
    from newsflow.sources.tables import lines_with_width
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(lines_with_width(spark, SF, ragged=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # From the top: the widths are broadcast, then the documents, then (below, without texts) the pages.
    joins = [line.split("Join", 1)[1].split("]")[0] for line in p.splitlines() if "Join [" in line]
    assert ["batch_url" in joins[0], "event_id" in joins[1], "user_id" in joins[2]] == [True] * 3 and len(joins) == 3
    assert "BroadcastHashJoin [batch_url" in p and p.count("Exchange hashpartitioning(batch_url") == 1  # of the widths
    assert p.index("doc_id#") < p.index("SortMergeJoin [user_id")


def test_the_landing_step_neither_splits_nor_rewrites_texts_by_a_regular_expression(spark, tmp_path):
    import datetime as dt
    from newsflow.sources.tables import gkg_view, lines_with_width, single_spaced
    texts = ["", " ", "a", " a", "a ", "a b c d e f", "a b c d e f ", "a b  c\td\ne\rf g", "\t\n\r  x ; ;; y\n\n",
             None, "a  b;c\x0bd\xa0e", "   ", "é 世\n界  z"]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    runs = r"[ \t\n\r]+"
    assert docs.filter(~F.regexp_replace("text", runs, " ").eqNullSafe(single_spaced(F.col("text")))).count() == 0
    at = dt.datetime(2026, 1, 1)
    events = spark.createDataFrame([(i, at, 0, "click", 5.0) for i in range(len(texts) + 1)],
                                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    pages = spark.createDataFrame([(0, "http://a.com/x")], "page_id long, url string")
    for name, df in {"documents": docs, "events": events, "pages": pages}.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    words = F.slice(F.split(F.coalesce("text", F.lit("")), runs), 1, 6)
    want = events.join(docs, events.event_id == docs.doc_id, "left").select(
        F.col("event_id").cast("string"), F.regexp_replace("text", runs, ";"), F.array_join(words, ";;"))
    got = gkg_view(spark, str(tmp_path)).select("record_id", "themes", "organizations")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    # a whole text is never split, and only a run of blanks is taken out by a regular expression
    landing = plan(lines_with_width(spark, str(tmp_path)))
    assert "split(" not in landing and "[ \\t\\n\\r]+" not in landing and "regexp_replace" in landing


def test_the_reject_rule_splits_the_head_of_a_line_only(spark):
    from newsflow.plans.normalize import normalize, producer_valid, project_lines, to_records, valid_line
    full = ["r", "20260101000000", "", "", "s", "http://a.com/x", "", "a;b;;c", *["x;y"] * 19]
    lines = [full, full[:6], full[:5], full[:1], [], ["r", "", *full[2:]], [*full[:5], "", *full[6:]], [*full, "more", ""]]
    df = spark.createDataFrame([(i, "\t".join(v)) for i, v in enumerate(lines)] + [(99, None)], "n int, value string")
    fields = project_lines(df, keep=("n",))
    stamp = F.lit("t")
    want = to_records(fields.filter(producer_valid()), stamp).collect()
    got = normalize(df, stamp, keep=("n",))
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) and {r.n for r in want} == {0, 1, 7}
    assert {r.n for r in df.filter(valid_line(F.col("value"))).collect()} == {0, 1, 7}
    rule = [x for x in plan(got.select("n")).splitlines() if "Filter" in x]
    assert rule and all(x.count("split(") == x.count("split(substring_index(") > 0 for x in rule)
    assert "translate(" not in plan(got) and "replace(themes" in plan(got)
