"""Quote-aware scan against Python's csv reader (fields) and pandas (missing values)."""

import csv
import io
import random

import pytest

from newsflow.plans.legacy import wide_scan_quoted
from newsflow.sources.quoted import MISSING, quoted_fields, quoted_records

PIECES = ['"', '""', "a", "\t", "\n", " ", "é", 'b"', '"c"', "NA", '\t"x\ty"', '"\n', '\t""']


def csv_records(text):
    """Records of ``text``; one that is never closed is left out."""
    lines = text.split("\n")
    out, at = [], 0
    while at < len(lines):
        if not lines[at].strip(" "):
            at += 1
            continue
        for end in range(at + 1, len(lines) + 1):
            chunk = "\n".join(lines[at:end])
            rows = list(csv.reader(io.StringIO(chunk + "\n\x01END\n", newline=""), delimiter="\t", quotechar='"'))
            if rows[-1] == ["\x01END"]:  # the record was closed before this line
                out.append((at, rows[0]))
                break
        at = end if rows[-1] == ["\x01END"] else len(lines)
    return out


def frame(spark, texts):
    rows = [(g, i, g, line) for g, text in texts.items() for i, line in enumerate(text.split("\n"))]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "archive string, line_no long, tag string, value string").repartition(4)


@pytest.mark.parametrize("chunk_lines", [2, 5, 65_536])
def test_records_against_csv(spark, chunk_lines):
    rng = random.Random(chunk_lines)
    texts = {f"f{i}": "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 60))) for i in range(120)}
    texts["plain"] = "\n".join(f"{i}\ta\tb" for i in range(300))
    texts["long"] = 'a\t"' + "\n".join(f"line {i}" for i in range(200)) + '"\tend\nnext\trow'
    texts["open"] = 'a\tb\nc\t"never\nclosed\n\nd\te'
    got = quoted_records(frame(spark, texts), "archive", "line_no", ("tag",), chunk_lines=chunk_lines)
    found = {(r.archive, r.line_no): (r.tag, r.f) for r in
             got.select("archive", "line_no", "tag", quoted_fields(got.value).alias("f")).collect()}
    want = {(g, at): (g, f) for g, text in texts.items() for at, f in csv_records(text)}
    assert found == want
    assert len(want[("long", 0)][1][1].split("\n")) == 200 and ("open", 1) not in want


def test_scan_against_pandas(spark):
    import pandas as pd
    rng = random.Random(9)
    cell = lambda: rng.choice(MISSING + ["x", '"q""q"', '"a\tb"', '"two\nlines"', "NAN", " NA", 'm"id', '"NA"', '"y" z'])
    texts = {}
    for g in range(12):
        first = "\t".join(["k0", "x", "y", "z"][:rng.randrange(2, 5)])
        rows = ["\t".join([f"k{i}"] + [cell() for _ in range(rng.randrange(0, 5))]) for i in range(1, 40)]
        texts[f"g{g}"] = "\n".join([first, "", "  ", *rows])
    got = wide_scan_quoted(frame(spark, texts), {0: "a", 1: "b", 3: "d"}, "archive", "line_no", chunk_lines=7)
    found = {}
    for r in got.orderBy("archive", "line_no").collect():
        found.setdefault(r.archive, []).append((r.a, r.b, r.d))
    for g, text in texts.items():
        df = pd.read_csv(io.StringIO(text), sep="\t", header=None, on_bad_lines="skip", dtype=str).fillna("")
        want = [(r[0], r[1], r[3] if len(df.columns) > 3 else None) for r in df.itertuples(index=False)]
        assert found[g] == want, g


def test_empty_and_quote_free(spark):
    empty = frame(spark, {"a": "x"}).filter("false")
    assert wide_scan_quoted(empty, {0: "a"}, "archive", "line_no").count() == 0
    assert [tuple(r) for r in wide_scan_quoted(frame(spark, {"a": "x\ty"}), {1: "b"}, "archive", "line_no").collect()] == [("a", 0, "y")]


def test_lines_without_quotes_are_not_brought_together(spark):
    """No exchange of raw lines is asked for but that of the records of several lines."""
    plan = quoted_records(frame(spark, {"a": "x\ty"}), "archive", "line_no")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1


def test_lines_are_brought_to_their_chunks_once_and_records_stay(spark):
    got = wide_scan_quoted(frame(spark, {"a": 'x\t"y\nz"\nu\tv', "b": "x\ty"}), {0: "a", 1: "b"}, "archive", "line_no")
    p = got._jdf.queryExecution().executedPlan().toString()
    assert "value#" in p and not any("SortMergeJoin" in line for line in p.splitlines())  # one row per archive is broadcast
    assert p.count("FileScan parquet") == 4 and "__chunk" not in p  # read as written, for the widths and for the rows
    assert sorted(tuple(r) for r in got.collect()) == [("a", 0, "x", "y\nz"), ("a", 2, "u", "v"), ("b", 0, "x", "y")]
