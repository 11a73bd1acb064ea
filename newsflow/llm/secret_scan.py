r"""Secret scans through a trigram inverted index (DataFrame functions only on the main path).

1. *Derive*: each rule's regex is read with Python's own ``re`` parser (on the
   driver, once) into a Boolean query over lower-cased trigrams: an OR of ANDs
   that every matching text must satisfy. A rule without mandatory trigrams
   (``[0-9a-f]{32,}``) has no query and scans every text.
2. *Index*: one scan emits, per text, the trigrams that occur in it (of those
   that any rule asks for) into posting lists ``(trigram, block) -> row keys``.
   Blocks are hash ranges of the row key of about ``block_rows`` rows, so a
   posting list is bounded and a trigram in every text is spread over all blocks.
   The index is a written table: more rules over the same trigrams reuse it.
3. *Intersect*: per block, AND is ``array_intersect`` and OR is ``array_union``
   of posting lists; the result is ``(row key, rules to verify)``.
4. *Verify*: texts join their candidates on the row key, and only there do the
   rules' regexes run, next to the rules that scan fully.

The row key is a 64-bit hash of id and text: rows that repeat both share a key
and a result, and a collision only adds a candidate to verify.

Spans are leftmost, non-overlapping matches per kind, kept when the checked group
is long enough. Offsets count code points. They come from the pieces between the
matches (``split``) and the matches' lengths, summed in blocks, so a text with
very many matches costs no quadratic copying.

Defined results: NULL text counts as empty (no spans); NULL and repeated ids are
ordinary rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.store import stored


@dataclass(frozen=True)
class Rule:
    """A span rule: ``pattern`` (both Python and Java read it alike), ``group`` of ``least`` or more characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed values (the patterns of the result's contract; letters of keywords in either case). A run
#: shorter than ``least`` cannot hold a longer one, so the minimum length is part of the last two patterns.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)

MAX_STRINGS = 64
BLOCK = 256


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """OR of ANDs of lower-case trigrams that every text matching ``pattern`` holds; None: no such condition."""
    import re._constants as sre
    import re._parser as parser

    def both(a, b):
        """AND of two queries (None is true), without terms that another term implies."""
        if a is None or b is None:
            return b if a is None else a
        return least({x | y for x, y in product(a, b)})

    def least(terms):
        return {t for t in terms if not any(o < t for o in terms)}

    def of_strings(strings):
        """The query of "one of these strings occurs"."""
        terms = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
        return None if frozenset() in terms else least(terms)

    def exact(node):
        """The set of strings a node can match, or None when there are too many."""
        op, arg = node
        if op is sre.LITERAL:
            return {chr(arg).lower()}
        if op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 4:
            return {chr(c).lower() for _, c in arg}
        if op is sre.SUBPATTERN:
            return sequence(arg[3])[0]
        if op is sre.BRANCH:
            parts = [sequence(alternative)[0] for alternative in arg[1]]
            return None if None in parts else set().union(*parts)
        if op is sre.MAX_REPEAT and arg[:2] == (0, 1):
            inner = sequence(arg[2])[0]
            return None if inner is None else inner | {""}
        return None

    def inexact(node):
        """The query of a node with too many strings."""
        op, arg = node
        if op is sre.SUBPATTERN:
            return sequence(arg[3])[1]
        if op is sre.BRANCH:
            parts = [sequence(alternative)[1] for alternative in arg[1]]
            return None if None in parts else least(set().union(*parts))
        if op is sre.MAX_REPEAT and arg[0] >= 1:
            return sequence(arg[2])[1]
        return None

    def sequence(nodes):
        """``(strings or None, query)`` of a run of nodes."""
        query, run, whole = None, {""}, True
        for node in nodes:
            strings = exact(node)
            joined = None if strings is None else {a + b for a in run for b in strings}
            if joined is not None and len(joined) <= MAX_STRINGS:
                run = joined
                continue
            whole = False
            query = both(query, of_strings(run))
            run = {""} if strings is None else strings
            if strings is None:
                query = both(query, inexact(node))
        query = both(query, of_strings(run))
        return (run if whole else None), query

    found = sequence(list(parser.parse(pattern)))[1]
    return None if found is None else sorted(found, key=sorted)


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), _text(text_col))


def build_index(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text",
                block_rows: int = 8192) -> DataFrame:
    """Posting lists ``(trigram, block, rows)`` of ``trigrams`` over every text, as a written table."""
    blocks = max(1, -(-docs.count() // block_rows))
    low = docs.select(_row_key(id_col, text_col).alias("row"), F.lower(_text(text_col)).alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    pairs = low.select("row", present.alias("present")).select("row", F.explode("present").alias("trigram"))
    return stored(pairs.groupBy("trigram", F.pmod("row", F.lit(blocks)).alias("block"))
                  .agg(F.collect_set("row").alias("rows")), "secret_postings")


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """``(row, kinds)``: the rows whose postings satisfy each kind's query."""
    trigrams = sorted({t for q in queries.values() for term in q for t in term})
    none = F.array().cast("array<bigint>")
    # first() of one list per (block, trigram): a bounded pivot, one row per block.
    lists = index.groupBy("block").agg(*[
        F.coalesce(F.first(F.when(F.col("trigram") == t, F.col("rows")), ignorenulls=True), none).alias(f"t{i}")
        for i, t in enumerate(trigrams)])
    at = {t: F.col(f"t{i}") for i, t in enumerate(trigrams)}

    def hits(query):
        out = none
        for term in query:
            rows = None
            for t in sorted(term):
                rows = at[t] if rows is None else F.array_intersect(rows, at[t])
            out = F.array_union(out, rows)
        return out

    def named(kind, query):
        return F.transform(hits(query), lambda r: F.struct(r.alias("row"), F.lit(kind).alias("kind")))

    found = lists.select(F.explode(F.flatten(F.array(*[named(k, q) for k, q in queries.items()]))).alias("hit"))
    found = found.select("hit.row", "hit.kind")
    return found.groupBy("row").agg(F.collect_set("kind").alias("kinds"))


def _before(lengths: Column, i) -> Column:
    """Sum of the first ``i`` elements of ``lengths``, at most BLOCK of them."""
    return F.aggregate(F.slice(lengths, F.lit(1), i), F.lit(0).cast("bigint"), lambda a, x: a + x)


def with_spans(df: DataFrame, rule: Rule, wanted: Column) -> DataFrame:
    """Adds ``spans_<kind>``: array of ``(start, kind order, kind, end)`` of the rule's kept matches."""
    k = rule.kind
    order = [r.kind for r in RULES].index(k) if k in [r.kind for r in RULES] else len(RULES)
    text, pattern = F.col("text"), F.lit(rule.pattern)
    none = F.array().cast("array<string>")
    df = df.withColumn("m", F.when(wanted, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(none))
    some = F.size("m") > 0
    df = df.withColumn("p", F.when(some, F.split(text, rule.pattern, -1)).otherwise(none)).withColumn(
        "v", F.when(some, F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else F.col("m"))
        .otherwise(none))
    # Lengths of piece + match; their sums per block of BLOCK, and before each block.
    df = df.withColumn("steps", F.transform("m", lambda m, i: (F.length(m) + F.length(F.get("p", i))).cast("bigint")))
    blocks = F.when(some, F.sequence(F.lit(0), F.floor((F.size("m") - 1) / BLOCK).cast("int"))).otherwise(
        F.array().cast("array<int>"))
    df = df.withColumn("sums", F.transform(blocks, lambda b: F.aggregate(
        F.slice("steps", b * BLOCK + 1, F.lit(BLOCK)), F.lit(0).cast("bigint"), lambda a, x: a + x)))
    df = df.withColumn("bases", F.transform("sums", lambda _, b: _before(F.col("sums"), b)))
    start = lambda i: (F.get("bases", F.floor(i / BLOCK).cast("int"))
                       + F.aggregate(F.slice("steps", i - i % BLOCK + 1, i % BLOCK), F.lit(0).cast("bigint"),
                                     lambda a, x: a + x) + F.length(F.get("p", i)))
    df = df.withColumn("at", F.transform("m", lambda m, i: F.struct(
        start(i).alias("start"), F.lit(order).alias("order"), F.lit(k).alias("kind"),
        F.length(m).cast("bigint").alias("size"), F.length(F.get("v", i)).alias("checked"))))
    kept = F.filter("at", lambda s: s["checked"] >= rule.least)
    spans = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"),
                                                 s["kind"].alias("kind"), (s["start"] + s["size"]).alias("end")))
    return df.withColumn(f"spans_{k}", spans).drop("m", "p", "v", "steps", "sums", "bases", "at")


def with_secrets(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
                 block_rows: int = 8192) -> DataFrame:
    """``(docs: struct of the row's columns, text, spans_<kind> ...)`` for every row of ``docs``."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not None}
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text_col])
    rows = docs.select(rest.alias("docs"), _text(text_col).alias("text"), _row_key(id_col, text_col).alias("row"))
    if indexed:
        trigrams = sorted({t for q in indexed.values() for term in q for t in term})
        index = build_index(docs, trigrams, id_col, text_col, block_rows)
        rows = rows.join(candidates(index, indexed), "row", "left")
    for rule in rules:
        wanted = F.lit(True) if rule.kind not in indexed else F.coalesce(
            F.array_contains("kinds", rule.kind), F.lit(False))
        rows = with_spans(rows, rule, wanted)
    return rows.select("docs", "text", *[f"spans_{r.kind}" for r in rules])


def scan_secrets(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
                 block_rows: int = 8192) -> DataFrame:
    """``(id, text, spans_<kind> ...)`` for every row of ``docs``."""
    found = with_secrets(docs.select(id_col, text_col), rules, id_col, text_col, block_rows)
    return found.select(F.col("docs").getField(id_col).alias("id"), *found.columns[1:])


def mask(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every secret masked; NULL texts become empty."""
    found = with_secrets(docs, rules, id_col, text_col)
    spans = F.flatten(F.array(*[F.col(f"spans_{r.kind}") for r in rules]))
    found = found.withColumn("spans", spans).withColumn("masked", masked(F.col("text"), F.col("spans")))
    return found.select(*[F.col("masked").alias(c) if c == text_col else F.col("docs").getField(c).alias(c)
                          for c in docs.columns])


def span_list(columns) -> Column:
    """``kind:start:end`` of all spans by start, then kind as listed, comma-joined."""
    spans = F.array_sort(F.flatten(F.array(*[F.col(c) for c in columns])))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every span replaced by ``mask``; overlapping spans share one mask."""
    ordered = F.array_sort(spans)
    init = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    walked = F.aggregate(ordered, init, lambda a, s: F.when(
        s["start"] >= a["at"], F.struct(s["end"].alias("at"), F.concat(a["parts"], F.array(
            F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mask)))
            .alias("parts"))).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                                                 a["parts"].alias("parts"))))
    rest = F.substring(text, (walked["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(walked["parts"], ""), rest))
