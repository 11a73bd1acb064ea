r"""Exact dedup: skew-safe combining with full-content comparison (DataFrame functions only).

Two texts are equal when they are identical after every character of
``[\x20\x09-\x0D]`` is deleted. Of equal texts the row with the most code points
in the original text stays, then the smallest id.

Stages (each groups on the digest *and* the normalised text itself, so a digest
collision can never merge different texts):

1. local: the map-side half of ``groupBy(digest, salt, text, length)``. The salt
   is the input split, so a task sends at most one row per distinct text and
   original length, whatever the number of copies it holds;
2. salted merge: the other half, on ``(digest, salt)``: the splits' rows of a hot
   text meet in ``salts`` tasks;
3. global: the salt winners (at most ``salts`` rows a text and length) meet on the digest.

Membership needs no text: a digest that stage 3 saw with one content stands for
that content, so documents join the winners on the digest alone (a narrow join;
a hot digest is split by the skew join). Digests with two contents, if any, are
resolved by joining on the content.

Defined results: NULL text counts as empty; NULL ids sort last (kept only when
the group has no other id); rows that repeat id and text are separate rows of
the group, one of which is kept; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.store import stored

REMOVED = " \t\n\x0b\x0c\r"
SALTS = 64


def normalised(text: Column) -> Column:
    r"""The text without the characters of ``[\x20\x09-\x0D]``."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), REMOVED, F.coalesce(text, F.lit("")))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _rows(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    """``(id, n, norm, digest)`` per input row."""
    rows = docs.select(F.col(id_col).alias("id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("n"),
                       normalised(F.col(text_col)).alias("norm"))
    return rows.withColumn("digest", digest(F.col("norm")))


def winners(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """``(digest, norm, keep_n, keep_id, group_size)``: one row per distinct normalised text."""
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    merged = salted.groupBy("digest", "salt", "norm", "n").agg(F.count(F.lit(1)).alias("size"),
                                                              F.min("id").alias("id"))
    # One exchange of the winners' texts serves both groupings.
    per_length = merged.repartition("digest").groupBy("digest", "norm", "n").agg(F.sum("size").alias("size"), F.min("id").alias("id"))
    return per_length.groupBy("digest", "norm").agg(
        F.max("n").alias("keep_n"), F.max_by("id", "n").alias("keep_id"), F.sum("size").alias("group_size"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256,
           salts: int = SALTS) -> DataFrame:
    """``(id, key, n, keep_id, keep_n, group_size, kept)`` for every row of ``docs``, dropped ones too.

    ``key`` names the content (the digest; with a variant number appended only where contents collide).
    """
    rows = _rows(docs, id_col, text_col, digest)
    found = winners(rows, salts)
    narrow = stored(found.drop("norm"), "dedup_winners")
    collided = narrow.groupBy("digest").count().filter("count > 1")
    members = rows.select("id", "n", F.col("digest").alias("key"))
    narrow = narrow.withColumnRenamed("digest", "key")
    if not collided.isEmpty():
        variant = found.join(collided.select("digest"), "digest", "left_semi").withColumn(
            "variant", F.sha2(F.concat(F.lit("variant"), F.hex(F.col("norm"))), 512))
        named = stored(found.join(variant.select("digest", "norm", "variant"), ["digest", "norm"], "left")
                       .withColumn("key", F.concat_ws("#", "digest", "variant")), "dedup_variants")
        members = rows.join(named.select("digest", "norm", "key"), ["digest", "norm"]).select("id", "n", "key")
        narrow = named.drop("digest", "norm", "variant")
    # Read back from files, so row numbers stay the same when a task runs again.
    members = stored(members, "dedup_members").withColumn("row", F.monotonically_increasing_id())
    first = members.groupBy("key", "n", "id").agg(F.min("row").alias("keep_row"))
    first = first.select(F.col("key").alias("k2"), "keep_row", F.col("n").alias("n2"), F.col("id").alias("id2"))
    picked = narrow.join(first, (F.col("key") == F.col("k2")) & (F.col("keep_n") == F.col("n2"))
                         & F.col("keep_id").eqNullSafe(F.col("id2"))).drop("k2", "n2", "id2")
    return (members.join(picked, "key").withColumn("kept", F.col("row") == F.col("keep_row"))
            .select("id", "key", "n", "keep_id", "keep_n", "group_size", "kept"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``."""
    g = groups(docs, id_col, text_col, salts=salts)
    return g.select(F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"),
                    "kept", F.col("key").alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct normalised text, with all their columns."""
    kept = groups(docs, id_col, text_col, salts=salts).filter("kept").select(
        F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("n").alias("__n"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumn("__k", sha256(normalised(F.col(text_col)))).withColumn("__m", F.length(text))
    out = keyed.join(kept, (F.col("__k") == F.substring_index("__key", "#", 1)) & (F.col("__m") == F.col("__n"))
                     & F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    return out.dropDuplicates([id_col, "__k", "__m"]).drop("__k", "__m")
