"""Records with quoted fields, found in raw lines without one task per file (SRC-5).

A field that begins with ``"`` runs to its closing quote, over separators and line ends; ``""`` stands
for one quote inside, text after the closing quote is literal, a quote elsewhere in a field too.

Whether a line begins inside a quoted field depends on all lines before it. Each line is a transition
between two states (outside, inside): a line without quotes keeps the state, so only lines with
quotes are looked at. The transitions of a chunk of lines are composed (the last constant one, then
the parity of the swaps after it), a prefix scan over the chunks' compositions gives each chunk the state that
it begins in, and the chunks' lines follow from it. What leaves the scan is one narrow row per record of several lines.

A record that is never closed has no end: its lines are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.operators.joins import materialize

CHUNK_LINES = 65_536

#: Texts that count as missing in the legacy reader (the defaults of its library).
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
           "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _closes(text: Column) -> Column:
    """Whether a quoted field that is open closes in ``text``: some run of quotes is odd."""
    return F.contains(F.replace(text, F.lit('""'), F.lit("")), F.lit('"'))


def _after(part: Column, open_: Column) -> Column:
    """Whether the quoted field is open after ``part`` (text between two separators)."""
    return F.when(open_, ~_closes(part)).otherwise(
        F.startswith(part, F.lit('"')) & ~_closes(F.substr(part, F.lit(2))))


def open_after(line: Column, sep: str = "\t") -> Column:
    """Whether a line that begins a record ends inside a quoted field."""
    return F.aggregate(F.split(line, sep, -1), F.lit(False), lambda state, part: _after(part, state))


def quoted_fields(record: Column, sep: str = "\t") -> Column:
    """The fields of a record, unquoted. Records without quotes are split plainly."""
    plain = F.split(record, sep, -1)
    start = F.struct(F.array().cast("array<string>").alias("f"), F.lit(False).alias("open"))

    def add(acc, part):
        n = F.size(acc["f"])
        grown = F.when(acc["open"], F.concat(
            F.slice(acc["f"], F.lit(1), n - 1), F.array(F.concat(F.element_at(acc["f"], -1), F.lit(sep), part)))).otherwise(
            F.concat(acc["f"], F.array(part)))
        return F.struct(grown.alias("f"), _after(part, acc["open"]).alias("open"))

    raw = F.aggregate(plain, start, add, lambda acc: acc["f"])
    return F.when(F.contains(record, F.lit('"')), F.transform(raw, unquote)).otherwise(plain)


def unquote(field: Column) -> Column:
    """A field's text: quotes taken off, doubled ones made single, what follows the closing quote kept."""
    body = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"?(.*)$'
    return F.when(F.startswith(field, F.lit('"')), F.concat(
        F.replace(F.regexp_extract(field, body, 1), F.lit('""'), F.lit('"')), F.regexp_extract(field, body, 2))).otherwise(field)


def record_spans(lines: DataFrame, group_col: str, order_col: str, sep: str = "\t",
                 chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """``(group, __chunk, __start, __end, __closed)``: the records of several lines, once per chunk that they touch.

    ``__end`` is the group's last line where the record is never closed.
    """
    value = F.col("value")
    chunk = lambda c: F.floor(F.col(c) / chunk_lines)
    bit = lambda c: c.cast("int")
    q = lines.filter(F.contains(value, F.lit('"'))).select(
        group_col, F.col(order_col).alias("__at"), bit(open_after(value, sep)).alias("__out"),
        bit(open_after(F.concat(F.lit('"'), value), sep)).alias("__in"))
    q = q.withColumn("__chunk", chunk("__at"))
    here = Window.partitionBy(group_col, "__chunk").orderBy("__at")
    # Within a chunk: parity of the swaps, and the last constant transition less the parity up to it.
    q = q.withColumn("__swaps", F.sum(bit((F.col("__out") == 1) & (F.col("__in") == 0))).over(here))
    constant = F.when(F.col("__out") == F.col("__in"), F.struct("__at", ((F.col("__out") + F.col("__swaps")) % 2).alias("b")))
    q = q.withColumn("__base", F.max(constant).over(here)["b"])
    # Chunks: the same composition over one row per chunk.
    c = q.groupBy(group_col, "__chunk").agg(F.max_by(F.struct("__swaps", "__base"), "__at").alias("l"))
    c = c.select(group_col, "__chunk", (F.col("l.__swaps") % 2).alias("p"), ((F.col("l.__base") + F.col("l.__swaps")) % 2).alias("v"))
    scan = Window.partitionBy(group_col).orderBy("__chunk")
    before = scan.rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("total", F.sum("p").over(scan))
    fixed = F.when(F.col("v").isNotNull(), F.struct("__chunk", ((F.col("v") + F.col("total")) % 2).alias("b")))
    entry = (F.coalesce(F.max(fixed).over(before)["b"], F.lit(0)) + F.col("total") - F.col("p")) % 2
    c = c.select(group_col, "__chunk", entry.alias("__entry"))
    # States of the lines.
    q = q.join(c, [group_col, "__chunk"])
    q = q.withColumn("__exit", (F.coalesce("__base", "__entry") + F.col("__swaps")) % 2)
    q = q.withColumn("__was", F.coalesce(F.lag("__exit").over(here), "__entry"))
    opener = F.when((F.col("__was") == 0) & (F.col("__exit") == 1), F.col("__at"))
    q = q.withColumn("__start", F.max(opener).over(here))
    carried = q.groupBy(group_col, "__chunk").agg(F.max("__start").alias("s")).withColumn("__carry", F.max("s").over(before))
    q = q.join(carried.select(group_col, "__chunk", "__carry"), [group_col, "__chunk"])
    closed = q.filter("__was = 1 AND __exit = 0").select(
        group_col, F.coalesce("__start", "__carry").alias("__start"), F.col("__at").alias("__end"), F.lit(True).alias("__closed"))
    last = lines.groupBy(group_col).agg(F.max(order_col).alias("__end"))
    open_ = (q.groupBy(group_col).agg(F.max_by("__exit", "__at").alias("e"), F.max("__start").alias("__start"))
             .filter("e = 1").join(last, group_col).select(group_col, "__start", "__end", F.lit(False).alias("__closed")))
    spans = closed.unionByName(open_)
    return spans.withColumn("__chunk", F.explode(F.sequence(chunk("__start"), chunk("__end"))))


def quoted_records(lines: DataFrame, group_col: str, order_col: str, keep: tuple[str, ...] = (), sep: str = "\t",
                   chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """``(group, order, *keep, value)``: one row per record; ``order`` and ``keep`` are those of its first line.

    Blank lines between records are left out. Lines of one record are the only ones that are brought together.
    """
    lines = lines.select(group_col, order_col, *keep, "value").withColumn("__chunk", F.floor(F.col(order_col) / chunk_lines))
    spans = record_spans(lines, group_col, order_col, sep, chunk_lines).alias("s")
    a = lines.alias("a")
    j = a.join(spans, (F.col(f"a.{group_col}") == F.col(f"s.{group_col}")) & (F.col("a.__chunk") == F.col("s.__chunk"))
               & F.col(f"a.{order_col}").between(F.col("s.__start"), F.col("s.__end")), "left")
    cols = [group_col, order_col, *keep, "value"]
    # Written once: both kinds of records are read from it, by every reader of the result.
    j = materialize(j.select(*[F.col(f"a.{c}").alias(c) for c in cols], "s.__start", "s.__closed"), "quoted")
    single = j.filter(F.col("__start").isNull() & (F.trim("value") != "")).select(*cols)
    parts = j.filter("__closed").groupBy(group_col, "__start").agg(
        *[F.min_by(c, order_col).alias(c) for c in keep],
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order_col, "value"))), lambda x: x["value"]), "\n").alias("value"))
    return single.unionByName(parts.withColumnRenamed("__start", order_col).select(*cols))
