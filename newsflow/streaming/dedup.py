"""Cross-batch dedup in a stream (DUP-2, stream form).

The legacy producer kept a set of sent URLs and, above 50,000, kept an
arbitrary 10,000. Here the state is bounded by time instead: the watermark
drops a key's state once event time has moved past it, so memory follows the
rate of new keys within the delay, not the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], time_col: str,
                           delay: str = "1 day") -> DataFrame:
    """First arrival of each key within ``delay`` of event time (``dropDuplicatesWithinWatermark``).

    ``withWatermark`` needs a session-zone ``timestamp``; a ``timestamp_ntz`` column is cast.
    Spark drops rows later than the watermark and reports them as
    ``numRowsDroppedByWatermark`` in the query progress.
    """
    if dict(df.dtypes).get(time_col) == "timestamp_ntz":
        df = df.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return df.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


#: After a batch a set of more than 50,000 sent keys is cut back to 10,000.
SENT_CAP, SENT_KEEP = 50_000, 10_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dedup_bounded(df: DataFrame, key: str, order: Sequence[str], cap: int = SENT_CAP, keep: int = SENT_KEEP,
                  buckets: int = 64) -> DataFrame:
    """First arrival of each key, with a memory bounded by count instead of time (DUP-2 as the legacy loop has it).

    Keys are dealt to ``buckets`` by hash. Each remembers its keys in the order in which they were sent
    (micro-batch, then ``order``). A bucket that holds more than ``cap / buckets`` keys after a micro-batch keeps the
    ``keep / buckets`` sent last; a key forgotten that way passes again. (The legacy set was cut in no
    stated order.) Within a micro-batch the row that is smallest by ``order`` passes; NULL order values come last,
    rows that tie are told apart by their columns. NULL is a key like any other. What was forgotten is counted:
    ``forgotten_keys``.

    Memory: a bucket's share of ``cap`` and, while its rows are read, one row per distinct key of the micro-batch.
    Needs the RocksDB state store (``use_rocksdb``).
    """
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor
    most, left = -(-cap // buckets), keep // buckets
    columns, order = list(df.columns), list(order)

    def rank(row):
        return [(row[c] is None, "" if row[c] is None else row[c]) for c in order] + [tuple(str(v) for v in row)]

    class Sent(StatefulProcessor):
        def init(self, handle) -> None:
            self.sent = handle.getListState("sent", "key string")
            self.forgotten = handle.getValueState("forgotten", "n long")

        def handleInputRows(self, key_, rows, timerValues):
            before = [r[0] for r in self.sent.get()]
            known, new = set(before), {}
            for row in rows:
                row = Row(*columns)(*[row[c] for c in columns])
                k = row[key]
                if k not in known and (k not in new or rank(row) < new[k][0]):
                    new[k] = rank(row), row
            passed = [row for _, row in sorted(new.values(), key=lambda x: x[0])]
            after = before + [row[key] for row in passed]
            if len(after) > most:
                kept = after[len(after) - left:]
                n = self.forgotten.get()[0] if self.forgotten.exists() else 0
                self.forgotten.update((n + len(after) - len(kept),))
                self.sent.clear()
                if kept:
                    self.sent.put([(k,) for k in kept])
            elif passed:
                self.sent.appendList([(row[key],) for row in passed])
            yield from passed

        def close(self) -> None:
            pass

    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    return dealt.groupBy("__bucket").transformWithState(
        statefulProcessor=Sent(), outputStructType=df.schema, outputMode="Append", timeMode="None")


def use_rocksdb(spark) -> None:
    """The state store that ``dedup_bounded`` needs, for queries started from now on (a checkpoint keeps its own)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def forgotten_keys(spark, checkpoint: str) -> DataFrame:
    """``(bucket, forgotten)``: how many keys each bucket has forgotten, from the query's checkpoint."""
    state = spark.read.format("statestore").option("stateVarName", "forgotten").load(checkpoint)
    return state.select(F.col("key.__bucket").alias("bucket"), F.col("value.n").alias("forgotten"))
