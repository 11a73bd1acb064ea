"""Hard negatives by Kronecker-packed products: exact integer scores of several candidates per multiplication.

1. *Blocks*: rows that take part are packed, task by task, into blocks of one dimension
   (at most ``BLOCK_ROWS`` rows), sorted by id, a written table; components are
   ``floor(256 x)``, written in the narrowest type that holds them. The anchors of a block have a column of their own.
2. *Packed products*: with both sides biased to be non-negative, a score is a field of
   ``width = bits(dim * 4 * max|a| * max|c|)`` bits. The components of ``fields`` candidates go into
   separate fields of one wide integer; multiplied by an anchor's component and summed over the
   components, every field holds its candidate's biased score, with no carry between fields.
   Integers up to 53 bits are held exactly by doubles, so a tile is one matrix product;
   wider fields use Python's long integers, one product per component for a whole block.
   Unpacking subtracts the biases: the scores are exact.
3. *Positives*: every anchor meets every candidate block of its dimension, in cells: blocks are dealt to
   ``strips`` parts, anchors to groups, so that a cell holds about ``CELL_BYTES`` of each. The two sides are
   cogrouped (a join might send one side, repeated for each strip, through the driver). A cell takes its blocks one after
   another, and only rows that can still be among an anchor's first are ranked; a cell's first rows of the
   anchor's label go on and heaps merge them.
4. *Negatives*: the anchors, now with their positives, meet the blocks again; per positive the first
   rows of another label inside its score window go on and heaps merge them.

Defined results: rows with a NULL id, label or vector, or a NULL or non-finite component take
no part; vectors of different length are never compared; empty vectors score 0; rows
that repeat an id are separate rows; fewer rows than asked for give fewer results, an anchor
without positives or a positive without negatives none; an empty table gives an empty result;
other columns are ignored. A score beyond 64 bits is compared exactly and returned as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.store import stored

SCALE = 256
BLOCK_ROWS = 8192
BLOCK_BYTES = 4 << 20
CELL_BYTES = 32 << 20  # of doubles, on either side of a cell
STEP = 128  # anchors multiplied at once
POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
WORD_BITS = 53  # integers that a double holds exactly
LONG = 1 << 63


def usable(rows: DataFrame, label: Column, id_col: str, vector_col: str) -> DataFrame:
    """``(id, label, v)`` of the rows that take part."""
    rows = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)


def pack_blocks(rows: DataFrame, anchor_every: int) -> DataFrame:
    """``(block, dim, ids, labels, vectors, anchors)``: rows of a block in the order of their ids; ``anchors``: the
    vectors of those whose id is divisible by ``anchor_every``."""
    def pack(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        part, made, held = TaskContext.get().partitionId(), 0, {}

        def flush(dim):
            nonlocal made
            ids, labels, vectors = (np.concatenate(x) for x in held.pop(dim))
            order = np.argsort(ids, kind="stable")
            ids, labels, whole = ids[order], labels[order], integers(vectors[order])
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 24) + made], pa.int64()), pa.array([dim], pa.int32()),
                 *[pa.array([x], pa.binary()) for x in (ids.tobytes(), labels.tobytes(), packed_integers(whole),
                                                        packed_integers(whole[ids % anchor_every == 0]))]],
                names=["block", "dim", "ids", "labels", "vectors", "anchors"])

        for batch in batches:
            ids, labels = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 1))
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy().astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes).tolist():
                which = np.flatnonzero(sizes == dim)
                most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(dim, 1))))
                while len(which):
                    got = held.setdefault(dim, ([], [], []))
                    room = most - sum(map(len, got[0]))
                    take, which = which[:room], which[room:]
                    got[0].append(ids[take])
                    got[1].append(labels[take])
                    got[2].append(values[starts[take][:, None] + np.arange(dim)])
                    if sum(map(len, got[0])) >= most:
                        yield flush(dim)
        for dim in list(held):
            yield flush(dim)

    return rows.select("id", "label", "v").mapInArrow(
        pack, "block long, dim int, ids binary, labels binary, vectors binary, anchors binary")


def integers(vectors):
    """``floor(SCALE x)`` as doubles holding integers, or as Python's integers where that passes a double."""
    import math

    import numpy as np
    with np.errstate(over="ignore"):
        q = np.floor(vectors * float(SCALE))
    if np.isfinite(q).all():
        return q
    exact = [[int(x) * SCALE if math.isinf(x * SCALE) else math.floor(x * SCALE) for x in row] for row in vectors.tolist()]
    out = np.empty(vectors.shape, dtype=object)
    out[:] = exact
    return out


def packed_integers(whole) -> bytes:
    """What ``integers`` returned, in the narrowest type that holds it, with a letter for the type in front."""
    import pickle

    import numpy as np
    if whole.dtype == object and whole.size:
        return b"o" + pickle.dumps(whole.tolist())
    for kind in ("b", "h", "i"):
        fits = np.iinfo(kind)
        if not whole.size or fits.min <= whole.min() and whole.max() <= fits.max:
            return kind.encode() + whole.astype(kind).tobytes()
    return b"d" + whole.tobytes()


def unpacked_integers(raw: bytes, rows: int, dim: int):
    import pickle

    import numpy as np
    if raw[:1] == b"o":
        out = np.empty((rows, dim), dtype=object)
        out[:] = pickle.loads(raw[1:])
        return out
    return np.frombuffer(raw, raw[:1].decode(), offset=1).reshape(rows, dim).astype(np.float64)


def field_bits(a, c) -> int:
    """Bits of the largest biased score of the integer rows ``a`` and ``c``."""
    most = lambda m: int(abs(m).max()) if m.size else 0
    return max(1, (a.shape[1] * 4 * most(a) * most(c)).bit_length())


def scores(a, c):
    """Exact inner products of the integer rows ``a`` and ``c``: int64, or Python's integers beyond 48 bits."""
    import numpy as np
    bits, dim = field_bits(a, c), a.shape[1]
    if bits > 48 or a.dtype == object or c.dtype == object:
        return _long_scores(a, c, bits)
    fields = WORD_BITS // bits
    bias_a, bias_c = (float(abs(m).max()) if m.size else 0.0 for m in (a, c))
    words = -(-len(c) // fields)
    padded = np.zeros((words * fields, dim))
    padded[:len(c)] = c + bias_c
    packed = sum(padded[f * words:(f + 1) * words] * float(1 << bits * f) for f in range(fields))
    product = ((a + bias_a) @ packed.T).astype(np.int64)
    mask = (1 << bits) - 1
    found = np.concatenate([product >> bits * f & mask for f in range(fields)], axis=1)[:, :len(c)]
    return (found - int(bias_c) * a.sum(axis=1).astype(np.int64)[:, None]
            - int(bias_a) * c.sum(axis=1).astype(np.int64) - dim * int(bias_a) * int(bias_c))


def _long_scores(a, c, bits: int):
    """The same with long integers: the components of all rows of ``c`` in one integer per dimension."""
    import numpy as np
    a, c = ([[int(x) for x in row] for row in m.tolist()] for m in (a, c))
    out = np.zeros((len(a), len(c)), dtype=object)
    if not c or not c[0]:
        return out
    dim, wide = len(c[0]), -(-bits // 8)
    bias_a, bias_c = (max(abs(x) for row in m for x in row) for m in (a, c))
    packed = [int.from_bytes(b"".join((row[d] + bias_c).to_bytes(wide, "little") for row in c), "little")
              for d in range(dim)]
    of_c = [bias_a * sum(row) for row in c]
    for i, row in enumerate(a):
        total = sum((x + bias_a) * p for x, p in zip(row, packed)).to_bytes(wide * len(c), "little")
        less = bias_c * sum(row) + dim * bias_a * bias_c
        out[i] = [int.from_bytes(total[j * wide:(j + 1) * wide], "little") - less - of_c[j] for j in range(len(c))]
    return out


def first_rows(score, fits, k: int):
    """``(row, column)`` of each row's ``k`` largest scores among those that fit, ties to smaller columns."""
    import numpy as np
    n = score.shape[1]
    if score.dtype == object:
        from heapq import nsmallest
        got = [(i, j) for i in range(len(score))
               for j in nsmallest(k, np.flatnonzero(fits[i]).tolist(), key=lambda j: (-score[i, j], j))]
        return np.array([i for i, _ in got], np.int64), np.array([j for _, j in got], np.int64)
    if n >= 64 and np.count_nonzero(fits) * 16 < fits.size:
        i, j = np.divmod(np.flatnonzero(fits), n)
        keep = _ranked(i, score[i, j], j, k)
        return i[keep], j[keep]
    none = -(1 << 62)
    key = np.where(fits, score * n + np.arange(n - 1, -1, -1), none)  # below 48 + 13 bits
    top = np.argpartition(key, n - k, axis=1)[:, n - k:] if n > k else np.broadcast_to(np.arange(n), key.shape)
    picked = np.take_along_axis(key, top, axis=1)
    order = np.argsort(-picked, axis=1, kind="stable")
    top, picked = np.take_along_axis(top, order, axis=1), np.take_along_axis(picked, order, axis=1)
    row, at = np.nonzero(picked > none)
    return row, top[row, at]


def _ranked(row, score, ids, k: int):
    """Which of the entries are each row's ``k`` first, by score, then id; ordered by row and rank."""
    import numpy as np
    if score.dtype == object:
        order = np.array(sorted(range(len(row)), key=lambda x: (row[x], -score[x], ids[x])), np.int64)
    else:
        order = np.lexsort((ids, -score, row))
    place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
    return order[place < k]


class Best:
    """The ``k`` first entries of each of ``n`` rows so far."""

    def __init__(self, n: int, k: int):
        import numpy as np
        self.k, self.full, self.last = k, np.zeros(n, bool), np.zeros(n, np.int64)
        self.row = self.ids = self.score = np.zeros(0, np.int64)

    def take(self, score, fits, ids) -> None:
        """The entries of a block that fit: the first columns alone while they can rule out others."""
        begin = len(ids) // 16 if len(ids) >= 16 * self.k and not self.full.all() else 0
        for cols in (slice(0, begin), slice(begin, None)) if begin else (slice(None),):
            part = score[:, cols]
            i, j = first_rows(part, fits[:, cols] & self._open(part), self.k)
            self._add(i, ids[cols][j], part[i, j])

    def _add(self, row, ids, score) -> None:
        import numpy as np
        if not len(row):
            return
        row, ids, score = (np.concatenate(x) for x in ((self.row, row), (self.ids, ids), (self.score, score)))
        keep = _ranked(row, score, ids, self.k)
        self.row, self.ids, self.score = row[keep], ids[keep], score[keep]
        self.full = np.bincount(self.row, minlength=len(self.full)) == self.k
        self.last = self.last.astype(score.dtype)
        self.last[self.full] = self.score[np.searchsorted(self.row, np.flatnonzero(self.full), side="right") - 1]

    def _open(self, score):
        """Which of the scores can still be among their row's first."""
        last = self.last
        if last.dtype == object and score.dtype != object:  # scores are within 48 bits here
            last = [max(-(1 << 60), min(1 << 60, x)) for x in last.tolist()]
        last = _column(last, score.dtype)
        return (score >= last).astype(bool) | ~self.full[:, None]


def _column(values, dtype):
    import numpy as np
    return np.array(values, dtype=dtype)[:, None]


def positive_cell(anchors: dict, blocks: list, k: int):
    """Rows ``(anchor row, anchor id, place, id, score)`` of the first same-label rows; ``place`` is 0."""
    import numpy as np
    for at in _steps(anchors):
        a, best = anchors["whole"](at), Best(len(anchors["ids"][at]), k)
        for block in blocks:
            score = scores(a, block["whole"])
            fits = (anchors["labels"][at][:, None] == block["labels"]) & (anchors["rows"][at][:, None] != block["rows"])
            best.take(score, fits, block["ids"])
        yield anchors["rows"][at][best.row], anchors["ids"][at][best.row], np.zeros(len(best.row), np.int64), best.ids, best.score


def negative_cell(anchors: dict, blocks: list, k: int):
    """The same for the first rows of another label in the window of the anchor's positive number ``place``."""
    import numpy as np
    for at in _steps(anchors):
        a, positives = anchors["whole"](at), anchors["positives"][at]
        places = range(max(map(len, positives), default=0))
        best = [Best(len(positives), k) for _ in places]
        # -(-x // 100) rounds up; a row without this positive gets an empty window
        windows = [([-(-LOW_PERCENT * p[place] // 100) if len(p) > place else 1 for p in positives],
                    [HIGH_PERCENT * p[place] // 100 if len(p) > place else 0 for p in positives]) for place in places]
        for block in blocks:
            score = scores(a, block["whole"])
            other = anchors["labels"][at][:, None] != block["labels"]
            for (low, high), found in zip(windows, best):
                if score.dtype != object:  # scores are within 48 bits here, positives of other tiles need not be
                    low, high = ([max(-(1 << 60), min(1 << 60, x)) for x in m] for m in (low, high))
                low, high = (_column(m, score.dtype) for m in (low, high))
                fits = (score >= low).astype(bool) & (score <= high).astype(bool)
                found.take(score, other & fits, block["ids"])
        for place, found in zip(places, best):
            yield (anchors["rows"][at][found.row], anchors["ids"][at][found.row], np.full(len(found.row), place),
                   found.ids, found.score)


def _steps(anchors: dict) -> list:
    return [slice(at, at + STEP) for at in range(0, len(anchors["ids"]), STEP)]


def _block_of(r: dict) -> dict:
    import numpy as np
    ids = np.frombuffer(r["ids"], np.int64)
    return {"ids": ids, "labels": np.frombuffer(r["labels"], np.int64), "rows": (r["block"] << 14) + np.arange(len(ids)),
            "whole": unpacked_integers(r["vectors"], len(ids), r["dim"])}


def _anchor_rows(blocks: DataFrame, every: int) -> DataFrame:
    """``(anchor, dim, id, label, vector)``: the rows whose id is divisible by ``every``."""
    def pick(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for r in batch.to_pylist():
                ids, labels = (np.frombuffer(r[n], np.int64) for n in ("ids", "labels"))
                which = np.flatnonzero(ids % every == 0)
                whole = unpacked_integers(r["anchors"], len(which), r["dim"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array((r["block"] << 14) + which), pa.array([r["dim"]] * len(which), pa.int32()),
                     pa.array(ids[which]), pa.array(labels[which]),
                     pa.array([packed_integers(whole[i:i + 1]) for i in range(len(which))], pa.binary())],
                    names=["anchor", "dim", "id", "label", "vector"])

    return blocks.select("block", "dim", "ids", "labels", "anchors").mapInArrow(
        pick, "anchor long, dim int, id long, label long, vector binary")


def _anchors_of(table, dim: int) -> dict:
    """The anchors of a cell, in the order of their rows."""
    import numpy as np
    table = table.sort_by("anchor")
    raw = table.column("vector").to_pylist()

    def whole(at):
        rows = [unpacked_integers(v, 1, dim) for v in raw[at]]
        return np.concatenate([x.astype(object) if any(y.dtype == object for y in rows) else x for x in rows])

    rows, ids, labels = (table.column(n).to_numpy() for n in ("anchor", "id", "label"))
    positives = [[int(x) for x in p or []] for p in table.column("positives").to_pylist()]
    return {"rows": rows, "ids": ids, "labels": labels, "whole": whole, "positives": positives}


def _cells(blocks: DataFrame, anchors: DataFrame, strips: int | None) -> tuple[int, int]:
    """``(strips, groups)``: into how many parts candidates and anchors are dealt, by their bytes as doubles.

    There are more strips than that asks for where cores would be idle, but no more than blocks.
    """
    size = lambda n: F.sum(n * 8 * (F.col("dim") + 2))
    n, held = blocks.agg(F.count(F.lit(1)), size(F.length("ids") / 8)).first()
    own = anchors.agg(size(F.lit(1))).first()[0] or 0
    cores = 4 * blocks.sparkSession.sparkContext.defaultParallelism
    return strips or max(1, min(n, max(-(-int(held or 0) // CELL_BYTES), cores))), max(1, -(-own // CELL_BYTES))


def _matched(anchors: DataFrame, blocks: DataFrame, cells: tuple[int, int], cell, k: int) -> DataFrame:
    """Every anchor against every block of its dimension: ``(anchor, anchor_id, place, id, score)``."""
    strips, groups = cells
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    queries = anchors.withColumn("group", part("anchor", groups)).withColumn(
        "strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
    candidates = blocks.drop("anchors").withColumn("strip", part("block", strips)).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def match(key, left, right):
        import numpy as np
        import pyarrow as pa
        names, dim = ["anchor", "anchor_id", "place", "id", "score"], key[0].as_py()
        held = [_block_of(r) for r in right.select(["block", "dim", "ids", "labels", "vectors"]).to_pylist()]
        made = [pa.table([*[pa.array(np.asarray(x, np.int64)) for x in (anchor, anchor_id, place, id_)],
                          pa.array([str(s) for s in score.tolist()], pa.string())], names=names)
                for anchor, anchor_id, place, id_, score in cell(_anchors_of(left, dim), held, k)]
        none = pa.table([pa.array([], pa.int64())] * 4 + [pa.array([], pa.string())], names=names)
        return pa.concat_tables([none, *made])

    cut = ["dim", "group", "strip"]
    return queries.groupBy(*cut).cogroup(candidates.groupBy(*cut)).applyInArrow(
        match, "anchor long, anchor_id long, place long, id long, score string")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` first rows of each (anchor, place) over all tiles, with their rank; a heap per run."""
    def merge(batches):
        from heapq import nsmallest
        from itertools import groupby

        import pyarrow as pa

        def rows_of():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for (anchor, anchor_id, place), run in groupby(rows_of(), key=lambda r: r[:3]):
            top = nsmallest(k, ((-int(r[4]), r[3]) for r in run))
            n = len(top)
            yield pa.RecordBatch.from_arrays(
                [pa.array([anchor] * n, pa.int64()), pa.array([anchor_id] * n, pa.int64()), pa.array([place] * n, pa.int64()),
                 pa.array(range(1, n + 1), pa.int32()), pa.array([i for _, i in top], pa.int64()),
                 pa.array([str(-s) for s, _ in top], pa.string())],
                names=["anchor", "anchor_id", "place", "rank", "id", "score"])

    runs = found.repartition("anchor").sortWithinPartitions("anchor", "place")
    return runs.mapInArrow(merge, "anchor long, anchor_id long, place long, rank int, id long, score string")


def hard_negatives(rows: DataFrame, id_col: str, vector_col: str, label: Column, anchor_every: int,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, strips: int | None = None) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of every anchor's positives.

    Anchors are the rows whose id is divisible by ``anchor_every``. Of the rows of another label whose
    score is ``LOW_PERCENT`` to ``HIGH_PERCENT`` percent of the positive's, the first ``negatives`` are returned.
    """
    blocks = stored(pack_blocks(usable(rows, label, id_col, vector_col), anchor_every), "labelled_blocks")
    anchors = stored(_anchor_rows(blocks, anchor_every), "anchors")
    cells = _cells(blocks, anchors, strips)
    near = stored(_merged(_matched(anchors.withColumn("positives", F.lit(None).cast("array<string>")), blocks, cells,
                                   positive_cell, positives), positives), "positives")
    listed = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("positives"))
    found = _merged(_matched(anchors.join(listed, "anchor").withColumn("positives", F.col("positives.score")), blocks,
                             cells, negative_cell, negatives), negatives)
    own = near.select("anchor", (F.col("rank") - 1).cast("long").alias("place"), F.col("id").alias("positive_id"),
                      F.col("score").alias("positive_score"))
    return found.join(own, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        F.expr("try_cast(positive_score AS BIGINT)").alias("positive_score"),
        F.expr("try_cast(score AS BIGINT)").alias("negative_score"))
