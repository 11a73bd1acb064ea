"""Best-fit packing of token sequences, planned on the histogram of lengths.

1. *Measure*: one map encodes every text, appends the end id and cuts documents
   longer than the capacity into pieces; only (id, piece, length, checksum) leave
   the task, as a written table.
2. *Plan*: best-fit decreasing over counts instead of documents. The driver gets
   one count per distinct length (at most ``capacity`` numbers, whatever the
   input). Sequences with equal remaining room are one contiguous range, and
   placing all pieces of a length takes whole ranges at a time, so the plan grows
   with the number of distinct lengths, not of documents.
3. *Place*: a piece's rank within its length picks its slot in the plan. The measuring
   task numbers its pieces per length as it writes them; the rank is that number plus the
   count of the tasks before it, a prefix sum per length. Nothing is sorted, a length
   that most documents share is as many parts as there were tasks, and a part is
   never more than one task's own pieces.

Best-fit puts a piece into the open sequence with the least remaining room that
holds it; the sequence just used keeps the least room until no further piece of
that length fits, so a length fills each range ``room // length`` pieces deep.

Defined results: NULL and empty texts are one piece of length 1 (the end id);
NULL and repeated ids are ordinary rows (each gets its own place); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from newsflow.llm.store import stored, worker_cache
from newsflow.llm.word_ids import WordIds, slices, strings

CAPACITY = 4096
END_ID = 1


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Slots ``(length, first rank, first sequence, pieces per sequence, offset)`` for ``counts`` pieces per length.

    The piece of rank ``r >= first rank`` (up to the length's next slot) goes to sequence
    ``first sequence + (r - first rank) // per`` at ``offset + (r - first rank) % per * length``.
    """
    slots, open_, rooms, used = [], {}, [], 0

    def put(room, first, n):
        if n and room:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, first, n = capacity, used, -(-left // (capacity // length))
                used += n
            per = room // length
            full = min(n, left // per)
            if full:
                slots.append((length, rank, first, per, capacity - room))
                put(room - per * length, first, full)
                left, rank, first, n = left - full * per, rank + full * per, first + full, n - full
            if n and left:  # fewer than per pieces are left: they share the next sequence
                slots.append((length, rank, first, left, capacity - room))
                put(room - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            put(room, first, n)
    return slots


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids_crc32, part, nth)`` per piece of every text: the ``nth`` of its length (from 0) in
    the task ``part``. Write it before use: a task that runs again may see its rows in another order."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    schema = StructType([rows.schema[id_col], StructField("piece", IntegerType()), StructField("start", LongType()),
                         StructField("length", LongType()), StructField("ids_crc32", LongType()),
                         StructField("part", IntegerType()), StructField("nth", LongType())])

    def cut(batches):
        from struct import pack
        from zlib import crc32

        import pyarrow as pa
        from pyspark import TaskContext
        encoder = worker_cache(("word ids", path), lambda: WordIds(path))
        end, part, seen = pack("<I", end_id), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts):
                ids, offsets = encoder.encode(texts.slice(a, b - a))
                raw, offsets = memoryview(ids).cast("B"), offsets.tolist()
                out = [[], [], [], [], [], []]
                for i in range(b - a):
                    first, stop = offsets[i], offsets[i + 1]
                    total = stop - first + 1
                    for k, start in enumerate(range(0, total, capacity)):
                        n = min(capacity, total - start)
                        last = start + n == total
                        crc = crc32(raw[4 * (first + start):4 * (first + start + n - last)])
                        for column, value in zip(out, (a + i, k, start, n, crc32(end, crc) if last else crc,
                                                       seen[n])):
                            column.append(value)
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int32()),
                     *[pa.array(c, pa.int64()) for c in out[2:5]], pa.array([part] * len(out[0]), pa.int32()),
                     pa.array(out[5], pa.int64())], names=schema.names)

    return rows.mapInArrow(cut, schema)


def place(measured: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``measured`` (a written table with ``length``, ``part`` and ``nth``) plus ``sequence_id, offset``."""
    # Two numbers per length and task that met it.
    per_part = stored(measured.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "packing_counts")
    # At most capacity rows of two numbers, whatever the input.
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    names = [c for c in measured.columns if c not in ("part", "nth")]
    ranked = measured.join(bases, ["length", "part"]).select(*names, (F.col("nth") + F.col("base")).alias("rank"))
    schema = StructType([*[measured.schema[c] for c in names], StructField("sequence_id", LongType()),
                         StructField("offset", LongType())])

    def assign(batches):
        import numpy as np
        import pyarrow as pa
        table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 5)
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            slot = table[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            past = rank - slot[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(slot[:, 2] + past // slot[:, 3]),
                 pa.array(slot[:, 4] + past % slot[:, 3] * length)], names=schema.names)

    return ranked.mapInArrow(assign, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)`` per piece."""
    measured = stored(pieces(docs, path, capacity, end_id, id_col, text_col), "packing_pieces")
    return place(measured, capacity)
