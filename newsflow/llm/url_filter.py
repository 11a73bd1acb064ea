"""URL filters: sorted sweep of reversed-host keys over nested rule intervals (DataFrame functions only).

A rule ``(host, path, verdict)`` fits its host and all subdomains when the URL's
path starts with the rule's path; the longest rule (code points of host + path,
then the smaller text) decides, and ``default`` decides where none fits.

Canonical keys turn both prefixes into intervals. The reversed host
``org.example.www.`` starts with ``org.example.`` exactly when the host is
``example.org`` or below it; a path starts with a rule's path exactly when it
lies in that prefix's interval. Intervals of one kind are nested or disjoint, so
a sweep in key order needs only a stack of the open ones. The stack is one
running ``last`` per nesting depth: an interval of depth *d* that holds the
point is always the latest of its depth to have started, so the slot's prefix
test is the pop. No rule is compared with every URL, nothing is broadcast.

1. host sweep: distinct hosts against rule hosts -> the rule hosts that hold each host;
2. path sweep: distinct (host, path) with those rule hosts against the rule paths.

The sweeps run per top label and per rule host. Points of each are dealt to
``salts`` parts by a hash and the rules repeated in every part, so a hot host or
label is ``salts`` tasks. Depth is at most the labels of a rule host, or the
nested rule paths of one host (each a bound set by the rules, not by the pages).

Defined results: a NULL URL or one without ``://`` has empty host and path and
fits no rule; the rule table must hold one verdict per (host, path) (repeats:
the smallest verdict, so ``allow`` before ``block``); empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.store import width


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    raw = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """``www.example.org`` -> ``org.example.www.`` (every label closed by a dot)."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def sweep(points: DataFrame, rules: DataFrame, depth: int, salts: int) -> DataFrame:
    """Points ``(part, key, payload)`` against rule prefixes ``(part, prefix, depth)`` in key order.

    Returns ``(part, key, payload, open)``: ``open`` lists, outermost first, the prefixes that hold the key.
    """
    dealt = points.withColumn("salt", F.pmod(F.xxhash64("key", "payload"), F.lit(salts)).cast("int"))
    copies = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    events = dealt.select("part", "salt", "key", "payload", F.lit(None).cast("int").alias("depth")).unionByName(
        copies.select("part", "salt", F.col("prefix").alias("key"),
                      F.lit(None).cast(points.schema["payload"].dataType).alias("payload"), "depth"))
    # A rule opens before the points at its own key.
    order = Window.partitionBy("part", "salt").orderBy("key", F.col("depth").isNull())
    slots = [F.last(F.when(F.col("depth") == d, F.col("key")), ignorenulls=True)
             .over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"slot{d}")
             for d in range(1, depth + 1)]
    swept = events.select("part", "key", "payload", "depth", *slots).filter(F.col("depth").isNull())
    held = F.array(*[F.when(F.startswith(F.col("key"), F.col(f"slot{d}")), F.col(f"slot{d}"))
                     for d in range(1, depth + 1)]) if depth else F.array().cast("array<string>")
    return swept.select("part", "key", "payload", F.array_compact(held).alias("open"))


def path_depths(rules: DataFrame) -> DataFrame:
    """``(part, prefix, depth)``: depth counts the paths of the same rule host that start the path, itself too."""
    prefixes = rules.select("part", "prefix", F.explode(F.transform(
        F.sequence(F.lit(0), F.length("prefix")), lambda n: F.substring(F.col("prefix"), 1, n))).alias("start"))
    starts = rules.select(F.col("part").alias("p2"), F.col("prefix").alias("start2"))
    return (prefixes.join(starts, (F.col("part") == F.col("p2")) & (F.col("start") == F.col("start2")))
            .groupBy("part", "prefix").agg(F.count(F.lit(1)).cast("int").alias("depth")))


def url_verdicts(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
                 salts: int | None = None) -> DataFrame:
    """``pages`` plus ``host, path, rule, verdict``; ``rules`` has ``host, path, verdict``."""
    spark = pages.sparkSession
    salts = salts or width(spark)
    rules = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict")).withColumn(
        "reversed", reversed_host(F.col("host")))
    labels = F.size(F.split("host", r"\."))
    hosts = rules.select("reversed", labels.alias("depth")).distinct()
    by_path = path_depths(rules.select(F.col("reversed").alias("part"), F.col("path").alias("prefix")))
    host_depth = hosts.agg(F.max("depth")).first()[0] or 0
    path_depth = by_path.agg(F.max("depth")).first()[0] or 0

    parsed = pages.drop("rule", "verdict").withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    points = parsed.filter("host <> ''").select("host", "path").distinct()
    top = F.substring_index(F.col("key"), ".", 1)
    keys = points.select("host").distinct().select(reversed_host(F.col("host")).alias("key"),
                                                   F.col("host").alias("payload")).withColumn("part", top)
    host_rules = hosts.select(F.col("reversed").alias("prefix"), "depth",
                              F.substring_index(F.col("reversed"), ".", 1).alias("part"))
    holding = sweep(keys, host_rules, host_depth, salts).select(
        F.col("payload").alias("host"), F.explode("open").alias("part"))

    urls = points.join(holding, "host").select("part", F.col("path").alias("key"), F.col("host").alias("payload"))
    fits = sweep(urls, by_path, path_depth, salts).filter(F.size("open") > 0).select(
        F.col("payload").alias("host"), F.col("key").alias("path"), "part",
        F.element_at("open", -1).alias("prefix"))
    named = fits.join(rules.select(F.col("reversed").alias("part"), F.col("path").alias("prefix"),
                                   F.concat("host", "path").alias("rule"), "verdict"), ["part", "prefix"])
    # Longest rule; of equal length the smaller text.
    first = F.min(F.struct((-F.length("rule")).alias("length"), "rule", "verdict"))
    best = named.groupBy("host", "path").agg(first.alias("best")).select("host", "path", "best.rule", "best.verdict")
    return (parsed.join(best, ["host", "path"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default))))
