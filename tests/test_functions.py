"""Edge rows of FIXTURES section 5 through the column functions (rules V1-V13)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from newsflow.functions import (
    build_text, clean_list, compact_to_iso, iso_to_ts, list_comma, list_pipe, parse_compact_ts,
    polarity_label, polarity_score, tone_label, tone_score, url_host,
)


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("c"))).collect()]


DATES = ["20260517120000", "2026051712", "20260517120000999", "bad", "", None]


def test_parse_compact_ts_v1_no_exception(spark):
    out = one_col(spark, DATES, parse_compact_ts)
    assert out[0] == dt.datetime(2026, 5, 17, 12, 0, 0)
    assert out[1:] == [None] * 5  # ANSI on: bad values give NULL, never an error


def test_compact_to_iso_v7(spark):
    out = one_col(spark, DATES, compact_to_iso)
    assert out[0] == "2026-05-17T12:00:00"
    assert out[1] == "2026-05-01T07:01:02"  # a short digit run, as the producer's strptime reads it
    assert one_col(spark, DATES, lambda c: compact_to_iso(c, strict=True))[1] is None
    assert out[2] == "2026-05-17T12:00:00"  # 17 digits: first 14 parsed
    assert out[3:] == [None, None, None]


def test_iso_to_ts_roundtrip(spark):
    out = one_col(spark, ["2026-05-17T12:00:00", "nonsense", None], iso_to_ts)
    assert out == [dt.datetime(2026, 5, 17, 12, 0), None, None]


TONES = ["1.5,2", "-2", "-2.01", "2", "2.1", "nan", "inf", " 1.5 ", "1_0", "x", "", None]


def test_tone_score_v8(spark):
    out = one_col(spark, TONES, tone_score)
    assert out[0] == 1.5 and out[1] == -2.0 and out[3] == 2.0
    assert math.isnan(out[5]) and math.isinf(out[6])
    assert out[7] == 1.5  # Spark trims spaces like Python float()
    assert out[8:] == [None, None, None, None]  # '1_0' rejected (Python would accept it)


def test_tone_label_v6_thresholds(spark):
    df = spark.createDataFrame([(v,) for v in [-2.01, -2.0, 0.0, 2.0, 2.01, None, float("nan")]], "s float")
    got = [r[0] for r in df.select(tone_label("s")).collect()]
    assert got == ["negative", "neutral", "neutral", "neutral", "positive", "neutral", "positive"]
    got = [r[0] for r in df.select(tone_label("s", nan_label="neutral")).collect()]
    assert got[-1] == "neutral"


def test_polarity_legacy(spark):
    vals = ["1.5,2", "3,1", "2,2", "-2", "x,1", "", "1.0005,0", "nan,1"]
    scores = one_col(spark, vals, polarity_score)
    labels = one_col(spark, vals, polarity_label)
    assert scores[:3] == [-0.5, 2.0, 0.0] and labels[:3] == ["negative", "positive", "neutral"]
    assert scores[3:6] == [0.0, 0.0, 0.0] and labels[3:6] == ["neutral"] * 3  # any failure -> (0.0, neutral)
    assert labels[6] == "positive"  # label from the unrounded value
    assert math.isnan(scores[7]) and labels[7] == "neutral"


LISTS = ["  A;;B; C;", "\tA;B", ";", "", None]


def test_clean_list_v3(spark):
    out = one_col(spark, LISTS, clean_list)
    assert out[0] == "a|b| c|"  # trim removes spaces only; inner spaces and trailing | survive
    assert out[1] == "\ta|b"
    assert out[2:] == ["|", "", None]


def test_list_pipe_and_comma(spark):
    assert one_col(spark, LISTS, list_pipe) == ["  A||B| C|", "\tA|B", "|", "", None]
    assert one_col(spark, [",A;b;", ";;x;;", ""], list_comma) == ["a,b", "x", ""]


def test_build_text_v10_never_null(spark):
    df = spark.createDataFrame([("a|b", None, "c", None), (None, None, None, None)], "t string, p string, o string, n string")
    got = [r[0] for r in df.select(build_text("t", "p", "o", "n")).collect()]
    assert got == ["a b c", ""]


def test_url_host_v5(spark):
    urls = ["http://a.com/x", "HTTPS://a.com", "ftp://z/", "https://b.org?q=1", "", None, "http://u:p@h:8080/x"]
    assert one_col(spark, urls, url_host) == ["a.com", "", "", "b.org?q=1", "", None, "u:p@h:8080"]


def test_producer_numbers_and_rounding_agree_with_python(spark):
    from newsflow.functions import polarity_score, producer_tone_score
    texts = ["1.5", "1.5d", "1.5f", " 2 ", "1_000", "1__0", "inf", "-Infinity", "nan", "+nan", ".5", "5.", "1e3", "", "x", "0x1"]

    def python(t):
        try:
            return float(t)
        except ValueError:
            return None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", producer_tone_score("t").alias("n")).collect():
        want = python(r.t)
        assert (r.n is None) == (want is None) and (want is None or r.n == want or want != want), r
    import random
    rng = random.Random(5)
    pairs = [(round(rng.uniform(-9, 9), rng.randint(1, 6)), round(rng.uniform(0, 3), rng.randint(1, 6))) for _ in range(3000)]
    pairs += [(1.0005, 0.0), (0.0625, 0.0), (2.0015, 0.0), (0.0025, 0.0), (-0.0625, 0.0), (1e15, 0.5)]
    df = spark.createDataFrame([(f"{a},{b}", round(a - abs(b), 3)) for a, b in pairs], "t string, want double")
    assert [r for r in df.select("t", "want", polarity_score("t").alias("got")).collect() if r.got != r.want] == []


def test_short_dates_read_as_strptime_reads_them(spark):
    from datetime import datetime

    from newsflow.functions import compact_to_iso
    texts = ["20260517123045", "2026051712", "202605171", "20261131000000", "2026051712304", "20260517123060", "2026",
             "2026051712304599", "bad", "", "20260230010203"]

    def python(t):
        try:
            return datetime.strptime(t[:14], "%Y%m%d%H%M%S").isoformat()
        except ValueError:
            return None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.loose, r.strict) for r in df.select("t", compact_to_iso("t").alias("loose"),
                                                       compact_to_iso("t", strict=True).alias("strict")).collect()}
    assert {t: v[0] for t, v in got.items()} == {t: python(t) for t in texts}
    assert got["2026051712"][1] is None and got["20260517123045"][1] == "2026-05-17T12:30:45"
