"""A history of keys with an index (SRC-9, DUP-2, DUP-3): a pass reads only the parts that may hold one of its keys.

Keys are stored by part (a day, a pass): ``keys/part=<p>`` holds the part's distinct keys, ``filters/part=<p>`` a
blocked Bloom filter over them. A block is a bitmap of 32,768 bits built by Spark's bitmap aggregation;
a key sets ``PROBES`` bits of one block. A part has as many blocks as ``bits_per_key`` asks for.

``drop_seen`` tests the new keys against all filters (a few bytes per stored key), then anti-joins with the keys of the
parts that answered "maybe": partition pruning leaves the others unread. A filter never misses a key, so
the result is that of ``dedup.drop_seen`` over the whole history.

Writing is safe to repeat: a part is replaced as a whole, its filter after its keys. A part without a filter (the
writer was lost in between) always counts as "maybe".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.dedup import drop_seen
from newsflow.sinks.parquet import path_exists

BLOCK_BITS = 32_768  # of Spark's bitmap functions
PROBES = 4
BITS_PER_KEY = 12


def _hash(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def _bits(key: str) -> Column:
    """The bit positions of a key in its block (both hashes reduced first: their sum does not fit 64 bits for every key)."""
    place, step = (F.pmod(h, F.lit(BLOCK_BITS)) for h in (_hash(key, 1), F.shiftright(_hash(key, 2), 20)))
    return F.array(*[F.pmod(place + i * step, F.lit(BLOCK_BITS)) for i in range(PROBES)])


class KeyHistory:
    """Keys seen so far, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, bits_per_key: float = BITS_PER_KEY):
        self.spark, self.bits_per_key = spark, bits_per_key
        self.keys_path, self.filters_path = f"{path.rstrip('/')}/keys", f"{path.rstrip('/')}/filters"

    def keys(self) -> DataFrame:
        return self._read(self.keys_path, "key string, part string")

    def filters(self) -> DataFrame:
        return self._read(self.filters_path, "blocks long, block long, bits binary, part string")

    def _read(self, path, schema):
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def append(self, rows: DataFrame, key: str, part: Column) -> None:
        """Add the non-NULL keys of ``rows``; each part that occurs is replaced by what ``rows`` has for it."""
        found = rows.select(F.col(key).cast("string").alias("key"), part.cast("string").alias("part")).filter(
            "key IS NOT NULL AND part IS NOT NULL").distinct()
        self._replace(found, self.keys_path)
        parts = [r.part for r in rows.select(part.cast("string").alias("part")).filter("part IS NOT NULL").distinct().collect()]
        mine = self.keys().filter(F.col("part").isin(parts))
        size = mine.groupBy("part").agg(
            F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) * F.lit(float(self.bits_per_key)) / BLOCK_BITS)).alias("blocks"))
        marked = mine.join(size, "part").select("part", "blocks", F.pmod(_hash("key", 0), F.col("blocks")).alias("block"),
                                                F.explode(_bits("key")).alias("bit"))
        filters = marked.groupBy("part", "blocks", "block").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
        self._replace(filters, self.filters_path)

    def _replace(self, rows: DataFrame, path: str) -> None:
        (rows.repartition("part", F.pmod(F.xxhash64(*rows.columns), F.lit(8))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path))

    def may_hold(self, rows: DataFrame, key: str) -> list[str]:
        """The parts that may hold a key of ``rows``: one name per part at most comes to the driver."""
        filters = self.filters()
        sizes = filters.select("part", "blocks").distinct()
        asked = rows.select(F.col(key).cast("string").alias("key")).filter("key IS NOT NULL").distinct()
        asked = asked.crossJoin(F.broadcast(sizes)).select(  # one row per part
            "part", F.pmod(_hash("key", 0), F.col("blocks")).alias("block"), _bits("key").alias("want"))
        hit = asked.join(filters.select("part", "block", "bits"), ["part", "block"]).filter(
            F.forall("want", lambda p: self._has(F.col("bits"), p)))
        listed = {r.part for r in hit.select("part").distinct().collect()}
        unindexed = self.keys().select("part").distinct().join(sizes.select("part"), "part", "left_anti")
        return sorted(listed | {r.part for r in unindexed.collect()})

    @staticmethod
    def _has(bits: Column, p: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, F.floor(p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(p, F.lit(8)))), F.lit(2)) == 1

    def seen(self, rows: DataFrame, key: str) -> DataFrame:
        """The stored keys of the parts that may hold a key of ``rows``."""
        return self.keys().filter(F.col("part").isin(self.may_hold(rows, key)))

    def drop_seen(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows whose key is in no part of the history (rows without a key stay)."""
        return drop_seen(rows, self.seen(rows, key).select(F.col("key").alias(key)), [key])
