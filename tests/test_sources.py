"""SRC-1..SRC-8 over generated files: ragged TSV, invalid UTF-8, zip archives, manifests."""

import io
import os
import zipfile

from pyspark.sql import functions as F

from newsflow.plans.legacy import wide_scan_skip_bad
from newsflow.plans.normalize import normalize, project_lines
from newsflow.schemas import LEGACY_PRODUCER_COLUMNS
from newsflow.sources.archives import read_archives, write_archives
from newsflow.sources.gkg import read_gkg, read_lines
from newsflow.sources.manifest import first_gkg_url, latest_urls


def gkg_line(n, rid="r1", date="20260517120000", url="http://a.com/x", tone="1.5,2", themes="A;;B"):
    f = [""] * n
    vals = {0: rid, 1: date, 4: "src", 5: url, 7: themes, 9: "loc", 11: "per", 12: "org", 15: tone, 23: "names"}
    for i, v in vals.items():
        if i < n:
            f[i] = v
    return "\t".join(f)


def write(path, data: bytes):
    with open(path, "wb") as fh:
        fh.write(data)


def test_tsv_explicit_schema_short_first_line(spark, scratch):
    lines = [gkg_line(10, "r0"), gkg_line(27, "r1"), "", gkg_line(30, "r2"), '   ', gkg_line(27, "r3", themes='say "hi"')]
    write(os.path.join(scratch, "a.csv"), ("\n".join(lines) + "\n").encode())
    df = read_gkg(spark, scratch)
    rows = {r.record_id: r for r in df.collect()}
    assert set(rows) == {"r0", "r1", "r2", "r3"}  # blank and spaces-only lines are skipped by the CSV reader
    assert rows["r0"].all_names is None and rows["r0"].url == "http://a.com/x"  # short row padded with NULL
    assert rows["r1"].all_names == "names" and rows["r2"].tone_raw == "1.5,2"
    assert rows["r3"].themes == 'say "hi"'  # no quoting: quotes stay literal


def test_invalid_utf8_replaced(spark, scratch):
    write(os.path.join(scratch, "b.csv"), gkg_line(27, "r\xff".encode("latin-1").decode("latin-1")).encode("latin-1") + b"\n")
    got = [r.value for r in read_lines(spark, scratch).collect()]
    assert got[0].startswith("r�")


def test_ragged_fields_and_producer_rules(spark):
    lines = spark.createDataFrame([(gkg_line(10, "a"),), (gkg_line(27, "b", url=""),), (gkg_line(27, "c", date=""),),
                                   (gkg_line(27, "d", date="bad"),), ("",)], "value string")
    fields = {r.record_id: r for r in project_lines(lines).collect()}
    assert fields["a"].persons == "" and fields["a"].tone_raw == ""  # past the end: ''
    recs = {r.record_id: r for r in normalize(lines, ingested_at=F.lit("t")).collect()}
    assert set(recs) == {"a", "d"}  # empty URL / raw date rejected, bad date kept with NULL time
    assert recs["d"].event_time is None and recs["a"].themes == "A||B" and recs["a"].tone_score is None


def test_wide_scan_first_line_sets_width(spark):
    lines = spark.createDataFrame([("z", 0, gkg_line(27, "a")), ("z", 1, gkg_line(30, "b")),
                                   ("z", 2, gkg_line(16, "c")), ("z", 3, "")], "arch string, n int, value string")
    lines = lines.withColumn("first_width", F.lit(27))  # as the archive reader gives it
    out = {r.event_date: r for r in wide_scan_skip_bad(lines, LEGACY_PRODUCER_COLUMNS, "arch", "n").collect()}
    assert set(out) == {"a", "c"}  # wider than the first line: dropped; blank: skipped
    assert out["c"].persons == "" and out["a"].tone_raw == ""  # narrower: padded; 25 past 27? no: '' value


def test_zip_roundtrip_streams_members(spark, scratch):
    lines = spark.createDataFrame([("feed/d1.gkg.csv.zip", i, gkg_line(27, f"r{i}")) for i in range(5)] +
                                  [("feed/d2.gkg.csv.zip", i, gkg_line(27, f"s{i}")) for i in range(3)],
                                  "batch_url string, line_no long, value string").repartition(2)
    written = write_archives(lines, scratch, "batch_url", "line_no").collect()
    assert sum(r.lines for r in written) == 8
    back = read_archives(spark, scratch, chunk_rows=2)
    got = sorted((r.member, r.value.split("\t")[0]) for r in back.collect())
    assert got == sorted([("d1.gkg.csv", f"r{i}") for i in range(5)] + [("d2.gkg.csv", f"s{i}") for i in range(3)])


def test_zip_first_csv_member_only(spark, scratch):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("a.csv", "l1\r\nl2\n")
        z.writestr("b.csv", "other\n")
    write(os.path.join(scratch, "one.zip"), buf.getvalue())
    got = [(r.member, r.line_no, r.value) for r in read_archives(spark, scratch).orderBy("line_no").collect()]
    assert got == [("a.csv", 0, "l1"), ("a.csv", 1, "l2")]


MANIFEST = [
    "10 abc http://x/20260517.export.CSV.zip",
    "11 abd http://x/20260517.mentions.CSV.zip",
    "12 abe http://x/20260517.gkg.csv.zip",
    "13 abf",
    "14 abg http://x/20260518.gkg.csv.zip",
    "  15   abh   http://x/other.zip  ",
]


def test_manifest_parse_and_first(spark):
    df = spark.createDataFrame([("m", i, v) for i, v in enumerate(MANIFEST)], "manifest string, line_no int, value string")
    kinds = {r.kind: r.url for r in latest_urls(df, "manifest", "line_no").collect()}
    assert kinds == {"export": "http://x/20260517.export.CSV.zip", "mentions": "http://x/20260517.mentions.CSV.zip",
                     "gkg": "http://x/20260518.gkg.csv.zip"}  # last line per kind wins; 2-part line ignored
    first = first_gkg_url(df, "manifest", "line_no").collect()
    assert [r.url for r in first] == ["http://x/20260517.gkg.csv.zip"]
