"""Nearest neighbours by largest inner product: a block matrix join over int8 tiles.

1. *Blocks*: usable vectors are packed, task by task, into blocks of one dimension
   (at most ``BLOCK_ROWS`` rows and ``BLOCK_BYTES`` bytes), a written table. A vector is stored
   with its int8 form (scale: largest component / 127) and the norm of its rounding error.
2. *Tiles*: the query rows of a block are a query block. Every query block meets
   every candidate block of its dimension, in tiles dealt to ``strips`` parts (the
   stated query set against all rows, in blocks).
3. *Prune*: an int8 product gives each score within
   ``|x - x'| |y| + |x'| |y - y'|``. The k-th best lower bound of a query in the tile is a
   floor; pairs whose upper bound is below it cannot be among its k best.
4. *Recompute and merge*: surviving pairs get their double-precision product from the
   original vectors; a tile's k best per query go on, and heaps merge the tiles'.

The result is exact at every scale: bounds only drop pairs that cannot be in it, and a pair whose bounds
overflow is recomputed. A score that overflows is infinite; one that is not a number comes last.

Defined results: rows whose id is NULL, or whose vector is NULL, empty, all zero or
holds a NULL or non-finite component take no part; vectors of different length are
never compared; rows that repeat an id are separate rows, each its own query and
a candidate of the others; ties go to the smaller id; fewer than k candidates give
fewer rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.store import stored, width

K = 20
BLOCK_ROWS = 8192
BLOCK_BYTES = 4 << 20
BLOCK_SCHEMA = "block long, dim int, ids binary, vectors binary"


def usable(rows: DataFrame) -> DataFrame:
    """Rows ``(id, v)`` that take part."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def pack_blocks(rows: DataFrame) -> DataFrame:
    """``(block, dim, ids, vectors)``: int64 ids and row-major doubles, per block."""
    def pack(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        part, made, held = TaskContext.get().partitionId(), 0, {}

        def flush(dim):
            nonlocal made
            ids, vectors = held.pop(dim)
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 24) + made], pa.int64()), pa.array([dim], pa.int32()),
                 pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                 pa.array([np.concatenate(vectors).tobytes()], pa.binary())],
                names=["block", "dim", "ids", "vectors"])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy().astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes).tolist():
                which = np.flatnonzero(sizes == dim)
                most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dim)))
                while len(which):
                    got = held.setdefault(dim, ([], []))
                    room = most - sum(map(len, got[0]))
                    take, which = which[:room], which[room:]
                    got[0].append(ids[take].astype(np.int64))
                    got[1].append(values[starts[take][:, None] + np.arange(dim)])
                    if sum(map(len, got[0])) >= most:
                        yield flush(dim)
        for dim in list(held):
            yield flush(dim)

    return rows.select("id", "v").mapInArrow(pack, BLOCK_SCHEMA)


def quantised(vectors):
    """``(int8 as float32, scale, norm, norm of the int8 form, norm of the error)`` per row."""
    import numpy as np
    scale = np.abs(vectors).max(axis=1) / 127.0
    scale[scale == 0] = 1.0  # a subnormal maximum
    q = np.clip(np.rint(vectors / scale[:, None]), -127, 127).astype(np.int8)
    back = q * scale[:, None]

    def norm(m):  # in units of the row's largest component: squares neither overflow nor vanish
        most = np.abs(m).max(axis=1)
        most[most == 0] = 1.0
        part = m / most[:, None]
        return most * np.sqrt((part * part).sum(axis=1))

    return q.astype(np.float32), scale, norm(vectors), norm(back), norm(vectors - back)


def tile_best(queries, query_rows, candidates, candidate_rows, ids, k: int, step: int = 128):
    """``(query index, id, score)`` of each query's ``k`` best candidates of the tile, its own row excepted."""
    import numpy as np
    cq, cs, cn, cb, ce = quantised(candidates)
    exact = np.float32 if candidates.shape[1] * 127 * 127 < 1 << 24 else np.float64  # integer sums stay exact
    cq = cq.astype(exact).T
    found = []
    for at in range(0, len(queries), step):
        x = queries[at:at + step]
        qq, qs, qn, qb, qe = quantised(x)
        with np.errstate(all="ignore"):  # what overflows has no bound and is recomputed
            score = (qq.astype(exact) @ cq).astype(np.float64) * qs[:, None] * cs
            slack = ((qe[:, None] * cn + qb[:, None] * ce) * (1 + 1e-9) + 1e-12 * qn[:, None] * cn
                     + candidates.shape[1] * 1e-322)
            high, low = score + slack, score - slack
        own = query_rows[at:at + step][:, None] == candidate_rows
        low = np.where(own | ~np.isfinite(low), -np.inf, low)
        floor = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(x), -np.inf)
        which, cand = np.nonzero(((high >= floor[:, None]) | ~np.isfinite(score) | ~np.isfinite(slack)) & ~own)
        for a in range(0, len(which), 1 << 16):
            w, c = which[a:a + (1 << 16)], cand[a:a + (1 << 16)]
            with np.errstate(all="ignore"):
                found.append((w + at, c, (x[w] * candidates[c]).sum(axis=1)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    which, cand, score = map(np.concatenate, zip(*found))
    order = np.lexsort((ids[cand], -score, which))
    which, cand, score = which[order], cand[order], score[order]
    place = np.arange(len(which)) - np.searchsorted(which, which)
    keep = place < k
    return which[keep], ids[cand[keep]], score[keep]


def nearest(rows: DataFrame, id_col: str, vector_col: str, query_every: int, k: int = K,
            strips: int | None = None) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest of every row whose id is divisible by ``query_every``."""
    strips = strips or width(rows.sparkSession)
    found = usable(rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")))
    blocks = stored(pack_blocks(found), "vector_blocks")
    queries = _query_rows(blocks, query_every).withColumn(
        "strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
    candidates = blocks.withColumn("strip", F.pmod(F.xxhash64("block"), F.lit(strips)).cast("int"))
    tiles = queries.join(candidates, ["dim", "strip"])

    def match(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for r in batch.to_pylist():
                dim, ids = r["dim"], np.frombuffer(r["ids"], np.int64)
                qi = np.frombuffer(r["query_ids"], np.int64)
                qr = np.frombuffer(r["query_rows"], np.int64)
                w, c, s = tile_best(np.frombuffer(r["query_vectors"]).reshape(-1, dim), qr,
                                    np.frombuffer(r["vectors"]).reshape(-1, dim),
                                    (r["block"] << 14) + np.arange(len(ids)), ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(qr[w]), pa.array(qi[w]), pa.array(c), pa.array(s)],
                                                 names=["query_row", "query_id", "id", "score"])

    best = tiles.mapInArrow(match, "query_row long, query_id long, id long, score double")
    # Runs of one query, merged by a heap of k.
    runs = best.repartition("query_row").sortWithinPartitions("query_row")

    def merge(batches):
        from heapq import nsmallest
        from itertools import groupby

        import pyarrow as pa

        def rows_of():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for _, run in groupby(rows_of(), key=lambda r: r[0]):
            top = nsmallest(k, run, key=lambda r: (r[3] != r[3], -r[3] if r[3] == r[3] else 0, r[2]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[1] for r in top], pa.int64()), pa.array(range(1, len(top) + 1), pa.int32()),
                 pa.array([r[2] for r in top], pa.int64()), pa.array([r[3] for r in top], pa.float64())],
                names=["query_id", "rank", "id", "score"])

    return runs.mapInArrow(merge, "query_id long, rank int, id long, score double")


def _query_rows(blocks: DataFrame, every: int) -> DataFrame:
    """``(dim, query_ids, query_rows, query_vectors)`` per block that holds query rows."""
    def pick(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                which = np.flatnonzero(ids % every == 0)
                if len(which):
                    vectors = np.frombuffer(r["vectors"]).reshape(-1, r["dim"])[which]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["dim"]], pa.int32()), pa.array([ids[which].tobytes()], pa.binary()),
                         pa.array([((r["block"] << 14) + which).tobytes()], pa.binary()),
                         pa.array([vectors.tobytes()], pa.binary())],
                        names=["dim", "query_ids", "query_rows", "query_vectors"])

    return blocks.mapInArrow(pick, "dim int, query_ids binary, query_rows binary, query_vectors binary")
