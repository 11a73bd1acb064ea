"""Suffix-array dedup: a difference-cover sort of the suffixes that can repeat, dealt out by content.

Every byte covered by a ``LENGTH``-byte string that also starts in a document with a
smaller id is removed; strings are judged on the input, and never cross documents.

1. *Rule out*: a suffix matters only if its first ``LENGTH`` bytes occur in two
   documents. Winnowing keeps of every run of ``LENGTH`` bytes one ``GRAM``-byte string (the
   least hash), the same one wherever the run occurs; where that string is in one
   document only, no such suffix repeats. This is exact for what it keeps: hash
   collisions only keep more. Which kept strings repeat is found per part of their hashes and
   returns to the texts by a join on buckets of texts; the texts are a bucketed table, so they are
   shuffled once. What is left is cut into pieces of bounded length, at places
   set by content, and equal pieces are sorted once, under their smallest document
   (in larger documents every suffix of the piece is covered).
2. *Deal out*: equal prefixes have the same kept string, so suffixes are dealt to parts
   by it, each with the bytes that its prefix needs. A kept string with more than
   ``MOST_RUNS`` runs is no part's work: its equal runs are merged by an aggregation, and
   the strings of the distinct ones compared by a second, both with partial results per task.
   In a part, runs none of whose strings has a hash that is there twice are left out too.
3. *Sort sampled triples*: in a part, positions 1 and 2 modulo 3 (a difference cover of
   3) get triples of 6-byte words, which are sorted and named by their order.
4. *Recurse on names*: the names at +0, +18 and +30 are the next triples; sorted
   and named again, a name stands for 48 bytes. No further level can change an
   answer about ``LENGTH`` = 50 bytes.
5. *Merge the remaining suffixes*: any two positions share an offset 0, 1 or 2 at which both
   are sampled. Under that offset a suffix is (bytes before, name, bytes after up to
   ``LENGTH``); every suffix takes part under both offsets of its residue.
6. *Compare adjacent prefixes*: in that order equal prefixes are neighbours; those whose
   document is larger than the smallest among their equals are covered.

Defined results: NULL text counts as empty; a NULL id is larger than every other
(it removes nothing); rows that repeat id and text get the same result and remove
nothing from each other; texts under ``LENGTH`` bytes are never cut; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.store import discard, stored
from newsflow.llm.word_ids import strings

LENGTH = 50
GRAM = 16
PIECE = 1 << 14
CUT_BITS = 3
WORD = 6
LAST = (1 << 63) - 1
RUN = "ord long, row long, pos int"
#: Bytes of texts per file, and per part of the kept strings; bytes of texts that are cut together.
PART_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20
#: Spark's limit for the files of a bucketed table.
MOST_FILES = 100_000
#: Bytes of distinct pieces whose runs are sorted together.
SORTED_BYTES = 1 << 20
#: Kept strings with more runs than this (counted from two in a batch on) are compared by aggregations.
MOST_RUNS = 20_000
#: Bytes of pieces that are winnowed at once.
AT_ONCE = 1 << 20


def gram_hashes(data):
    """64-bit hash of the ``GRAM`` bytes that start at every byte of a numpy byte array (the last ones are short)."""
    import numpy as np
    h = data.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x94D049BB133111EB)
    width, factor = 1, 0xD6E8FEB86659FD93
    while width < GRAM:
        h[:-width] = h[:-width] * np.uint64(factor) + h[width:]
        width, factor = 2 * width, factor * factor % (1 << 64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def winnowed(data):
    """For every run of ``LENGTH`` bytes of one text, by its start: the least hash of a ``GRAM``-byte string in it."""
    import numpy as np
    runs = LENGTH - GRAM + 1
    least, span = gram_hashes(data), 1
    n = len(data) - LENGTH + 1
    while span * 2 <= runs:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return np.minimum(least[:n], least[runs - span:runs - span + n])


def _bytes(texts):
    import numpy as np
    for text in texts.to_pylist():
        yield np.frombuffer(text.encode("utf-8"), dtype=np.uint8)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, ord, row, text)``: ``ord`` orders ids (NULL last), ``(ord, row)`` names id and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("ord"),
                       F.xxhash64(F.col(id_col), text).alias("row"), text.alias("text"))


def bucketed(keyed: DataFrame) -> tuple[DataFrame, int]:
    """The texts as a written table, bucketed by ``bucket`` (about ``BUCKET_BYTES`` of texts have one), and how many
    files it has. Whatever is found out about a bucket's texts later joins them without moving them again."""
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = min(MOST_FILES, 1 + size // PART_BYTES)
    dealt_out = keyed.withColumn("bucket", F.pmod("row", F.lit(1 + size // BUCKET_BYTES)))
    return stored(dealt_out.repartition(files, "bucket"), "suffix_texts", "zstd", bucket=(files, "bucket")), files


def _code(kept, parts):
    """A kept string's part (upper half) and its 32-bit fingerprint there; a part has about a million."""
    import numpy as np
    return (kept >> np.uint64(32)) % np.uint64(parts) << np.uint64(32) | kept & np.uint64(0xFFFFFFFF)


def shared_grams(texts: DataFrame, parts: int) -> DataFrame:
    """``(bucket, part, grams)``: of each bucket's kept strings the fingerprints that occur in two texts or more."""
    def fingerprints(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            buckets, data = batch.column(0).to_numpy(), strings(batch.column(1))
            edge = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for low, high in zip(edge, edge[1:]):
                own = [_kept_once(d) for d in _bytes(data.slice(low, high - low)) if len(d) >= LENGTH]
                if not own:
                    continue
                codes, count = np.unique(_code(np.concatenate([np.unique(o) for o in own]), parts), return_counts=True)
                codes = np.repeat(codes, np.minimum(count, 2))
                which, start = np.unique(codes >> np.uint64(32), return_index=True)
                stop = np.append(start[1:], len(codes)).tolist()
                short = codes.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(which), buckets[low])), pa.array(which.astype(np.int32)),
                     pa.array([short[i:j].tobytes() for i, j in zip(start.tolist(), stop)], pa.binary())],
                    names=["bucket", "part", "grams"])

    def repeated(table):
        import numpy as np
        import pyarrow as pa
        each = [np.frombuffer(g, np.uint32) for g in table.column("grams").to_pylist()]
        grams, count = np.unique(np.concatenate(each), return_counts=True)
        grams = grams[count > 1]
        own = [np.unique(g[_found(g, grams)]).tobytes() for g in each]
        return pa.table({"bucket": table.column("bucket"), "part": table.column("part"),
                         "grams": pa.array(own, pa.binary())})

    schema = "bucket long, part int, grams binary"
    found = texts.select("bucket", "text").mapInArrow(fingerprints, schema)
    return found.groupBy("part").applyInArrow(repeated, schema).filter("length(grams) > 0")


def _kept_once(data):
    import numpy as np
    kept = winnowed(data)
    return kept[np.append(True, kept[1:] != kept[:-1])]


def _found(values, known):
    """Which of ``values`` are in the sorted array ``known``."""
    import numpy as np
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _among(kept, grams):
    """Which of ``kept`` are in the sorted array ``grams`` (looked up once per run of equal values)."""
    import numpy as np
    first = np.append(True, kept[1:] != kept[:-1])
    return _found(kept[first], grams)[np.cumsum(first) - 1]


def _cut(data, grams, parts):
    """``(position, bytes)`` of the pieces of one text whose kept strings are among ``grams``."""
    import numpy as np
    kept = winnowed(data)
    first = np.flatnonzero(np.append(True, kept[1:] != kept[:-1]))
    values = kept[first]
    hit = _found(_code(values, parts), grams)
    # A run's kept string changes and the new one's hash ends in zeros: a cut set by content.
    begins = hit & (np.append(True, ~hit[:-1]) | (values & np.uint64((1 << CUT_BITS) - 1) == 0))
    ends = hit & np.append(~hit[1:] | begins[1:], True)
    for low, high in zip(first[begins].tolist(), np.append(first[1:], len(kept))[ends].tolist()):
        for at in range(low, high, PIECE):
            yield at, data[at:min(at + PIECE, high) + LENGTH - 1].tobytes()


def pieces(texts: DataFrame, parts: int) -> DataFrame:
    """``(bucket, ord, row, pos, data)``: overlapping pieces that hold every run of bytes that two documents may share."""
    def cut(own, shared):
        import numpy as np
        import pyarrow as pa
        known = [np.uint64(p) << np.uint64(32) | np.frombuffer(g, np.uint32).astype(np.uint64)
                 for p, g in zip(shared.column("part").to_pylist(), shared.column("grams").to_pylist())]
        known = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        out = [], [], []
        for i, data in enumerate(_bytes(own.column("text"))):
            if len(known) and len(data) >= LENGTH:
                for at, piece in _cut(data, known, parts):
                    for column, value in zip(out, (i, at, piece)):
                        column.append(value)
        which = pa.array(out[0], pa.int64())
        return pa.table([*[own.column(c).take(which) for c in ("bucket", "ord", "row")], pa.array(out[1], pa.int32()),
                         pa.array(out[2], pa.binary())], names=["bucket", "ord", "row", "pos", "data"])

    shared = shared_grams(texts, parts).groupBy("bucket")
    return (texts.select("bucket", "ord", "row", "text").groupBy("bucket").cogroup(shared)
            .applyInArrow(cut, "bucket long, " + RUN + ", data binary"))


def ranked(values):
    """Each value's place among the distinct ones, from 0."""
    import numpy as np
    order = np.argsort(values)
    by = values[order]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(np.append(False, by[1:] != by[:-1])[:len(by)])
    return out


def joined_keys(a, b):
    """One integer per pair that orders as ``(a, b)`` does; values that are too wide give way to their places."""
    bits = lambda x: int(x.max(initial=0)).bit_length()
    if bits(a) + bits(b) > 62:
        a = ranked(a)
    if bits(a) + bits(b) > 62:
        b = ranked(b)
    return a << bits(b) | b


def names_of(a, b, c):
    """The places of the triples ``(a, b, c)`` in their sorted order; equal triples share one."""
    return ranked(joined_keys(joined_keys(a, b), c))


def repeating(runs: list):
    """Which of ``runs`` hold a ``LENGTH``-byte string whose hash is there twice (collisions only keep more)."""
    import numpy as np
    size = np.array([len(r) for r in runs], dtype=np.int64)
    raw, n = np.frombuffer(b"".join(runs), np.uint8), size - (LENGTH - 1)
    grams = gram_hashes(raw)
    whole = grams[:len(raw) - LENGTH + 1].copy()
    for k in (GRAM, 2 * GRAM, LENGTH - GRAM):
        whole = whole * np.uint64(0x9E3779B97F4A7C15) + grams[k:k + len(whole)]
        whole ^= whole >> np.uint64(29)
    which = np.repeat(np.arange(len(runs)), n)
    whole = whole[np.arange(len(which)) + np.repeat(np.cumsum(size) - size - (np.cumsum(n) - n), n)]
    by = np.sort(whole)
    return np.unique(which[_found(whole, by[1:][by[1:] == by[:-1]])])


def covered_starts(runs: list, ords):
    """Per run of bytes (of the document in ``ords``) which of its ``LENGTH``-byte strings start in a smaller
    document's run too: a boolean array over the joined runs, and where each run starts in it."""
    import numpy as np
    size = np.array([len(r) for r in runs], dtype=np.int64)
    start = np.cumsum(size) - size
    data = np.frombuffer(b"".join(runs), np.uint8).astype(np.int64)
    word = np.zeros(len(data) - WORD + 1, dtype=np.int64)
    for k in range(WORD):
        word = word << 8 | data[k:k + len(word)]
    inside = np.arange(len(data)) - np.repeat(start, size)
    # How far a place lies before its run's last string; no step below looks beyond the run's end.
    ahead = np.repeat(size, size) - LENGTH - inside
    sampled = inside % 3 != 0
    # Sort the sampled triples of words, then of their names, as far as a suffix of full length reaches.
    words, names = (np.zeros(len(data), dtype=np.int64) for _ in range(2))
    at = np.flatnonzero(sampled & (ahead >= WORD - LENGTH))
    words[at] = ranked(word[at])
    at = np.flatnonzero(sampled & (ahead >= -32))
    names[at] = names_of(words[at], words[at + WORD], words[at + 2 * WORD])
    at = np.flatnonzero(sampled & (ahead >= -2))
    names[at] = names_of(names[at], names[at + 18], names[at + 30])
    # Merge all suffixes under the offsets at which they reach a sampled one; equal ones are neighbours.
    at = np.flatnonzero(ahead >= 0)
    residue, own = inside[at] % 3, np.repeat(ords, size)[at]
    out = np.zeros(len(data), dtype=bool)
    for offset in range(3):
        take = (residue + offset) % 3 != 0
        p, ids = at[take], own[take]
        if not len(p):
            continue
        ends = np.zeros(len(p), dtype=np.int64)
        for k in (*range(offset), *range(offset + 48, LENGTH)):
            ends = ends << 8 | data[p + k]
        key = joined_keys(ends, names[p + offset])
        order = np.argsort(key)
        by, i = key[order], ids[order]
        new = np.append(True, by[1:] != by[:-1])
        smallest = np.minimum.reduceat(i, np.flatnonzero(new))[np.cumsum(new) - 1]
        out[p[order[i > smallest]]] = True
    return out, start


def _runs(pieces):
    """``(kept, piece, at, stop)`` of the runs of suffixes of one kept string, for slices of ``pieces``."""
    import numpy as np
    low, sizes = 0, np.array([len(p) for p in pieces], dtype=np.int64)
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(np.cumsum(sizes[low:]), AT_ONCE)) + low)
        size = sizes[low:high]
        n = size - (LENGTH - 1)
        which = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        # No string of a run reaches beyond its piece, so the pieces can be winnowed as one text.
        kept = winnowed(np.frombuffer(b"".join(pieces[low:high]), np.uint8))[np.repeat(np.cumsum(size) - size, n) + inside]
        first = np.flatnonzero(np.append(True, (kept[1:] != kept[:-1]) | (which[1:] != which[:-1])))
        yield kept[first], which[first] + low, inside[first], inside[np.append(first[1:], len(kept)) - 1] + 1
        low = high


def hot_grams(parts: DataFrame) -> DataFrame:
    """``(gram)``: kept strings of more than ``MOST_RUNS`` runs; a batch leaves out those it has once."""
    def counts(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            own = [kept for kept, *_ in _runs(batch.column(0).to_pylist())]
            if own:
                grams, n = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams[n > 1].view(np.int64)), pa.array(n[n > 1].astype(np.int64))],
                                                 names=["gram", "n"])

    found = parts.select("data").mapInArrow(counts, "gram long, n long")
    return found.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > MOST_RUNS).select("gram")


def covered_by_strings(runs: DataFrame) -> DataFrame:
    """``(row, pos, found)`` from ``runs(ord, row, pos, at, data)``: equal runs are merged, then their strings."""
    runs = stored(runs.withColumn("key", F.unhex(F.sha2("data", 256))), "suffix_hot")
    once = stored(runs.groupBy("key", "data").agg(F.min("ord").alias("low")), "suffix_hot_once")
    each = once.select("key", "low", F.explode(F.expr(
        f"transform(sequence(0, length(data) - {LENGTH}), k -> struct(k, substring(data, k + 1, {LENGTH}) as string))")).alias(
        "s")).select("key", "low", "s.k", "s.string")
    # Written first, so that the joins can be split at a string or run that very many share.
    least = stored(each.groupBy("string").agg(F.min("low").alias("least")), "suffix_hot_least")
    hits = each.join(least, "string").filter("low > least").groupBy("key").agg(F.collect_list("k").alias("hits"))
    known = stored(once.select("key", "low").join(hits, "key", "left"), "suffix_hot_known")
    return runs.join(known, "key").filter("ord > low or hits is not null").select("row", "pos", F.expr(
        f"transform(if(ord > low, sequence(0, length(data) - {LENGTH}), hits), k -> k + at)").alias("found"))


def dealt(parts: DataFrame) -> tuple:
    """The runs of ``parts(ord, row, pos, data)``: packed per part, and ``(ord, row, pos, at, data)`` of the hot kept
    strings (None: there are none)."""
    import numpy as np
    deal = 1 + (parts.agg(F.sum(F.length("data"))).first()[0] or 0) // SORTED_BYTES
    # At most one of 20,000 runs' kept strings is in this array.
    hot = np.sort(np.array([r.gram for r in hot_grams(parts).collect()], dtype=np.int64).view(np.uint64))
    held = parts.sparkSession.sparkContext.broadcast(hot)

    def runs(batches):
        """Suffixes of one kept string that follow each other, packed per part."""
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            rows, pieces = [], batch.column(3).to_pylist()
            for kept, piece, at, end in _runs(pieces):
                cold = ~_among(kept, held.value)
                part = (kept >> np.uint64(20)) % np.uint64(deal)
                rows += [(k, i, a, pieces[i][a:b + LENGTH - 1])
                         for k, i, a, b in zip(*(x[cold].tolist() for x in (part, piece, at, end)))]
            rows.sort(key=lambda r: r[0])
            part = np.array([r[0] for r in rows], dtype=np.int32)
            which, start = np.unique(part, return_index=True)
            stop = np.append(start[1:], len(part)).tolist()
            columns = [batch.column(k).to_numpy() for k in range(3)]
            out = []
            for low, high in zip(start.tolist(), stop):
                piece = np.array([r[1] for r in rows[low:high]])
                out.append([columns[0][piece].astype(np.int64).tobytes(), columns[1][piece].astype(np.int64).tobytes(),
                            columns[2][piece].astype(np.int32).tobytes(),
                            np.array([r[2] for r in rows[low:high]], np.int32).tobytes(),
                            np.array([len(r[3]) for r in rows[low:high]], np.int32).tobytes(),
                            b"".join(r[3] for r in rows[low:high])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(which), *[pa.array([o[k] for o in out], pa.binary()) for k in range(6)]],
                names=["part", "ord", "row", "pos", "at", "size", "data"])

    def hot_runs(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            pieces = batch.column(3).to_pylist()
            for kept, piece, at, end in _runs(pieces):
                take = _among(kept, held.value)
                piece, at, end = piece[take], at[take], end[take]
                data = [pieces[i][a:b + LENGTH - 1] for i, a, b in zip(piece.tolist(), at.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(pa.array(piece)) for k in range(3)], pa.array(at.astype(np.int32)),
                     pa.array(data, pa.binary())], names=["ord", "row", "pos", "at", "data"])

    parts = parts.select("ord", "row", "pos", "data")
    packed = parts.mapInArrow(
        runs, "part int, ord binary, row binary, pos binary, at binary, size binary, data binary")
    return packed, parts.mapInArrow(hot_runs, RUN + ", at int, data binary") if len(hot) else None


def covered(parts: DataFrame) -> DataFrame:
    """``(row, pos, found)``: places in the pieces whose ``LENGTH``-byte string starts in a smaller document's piece."""
    def sort(table):
        import numpy as np
        import pyarrow as pa
        column = lambda n, t: np.frombuffer(b"".join(table.column(n).to_pylist()), t)
        ords, rows, pos, at = column("ord", np.int64), column("row", np.int64), column("pos", np.int32), column("at", np.int32)
        size = column("size", np.int32).astype(np.int64)
        raw = b"".join(table.column("data").to_pylist())
        stop = np.cumsum(size)
        coded = pa.array([raw[a:b] for a, b in zip((stop - size).tolist(), stop.tolist())], pa.binary()).dictionary_encode()
        code, texts = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        # Equal runs once, under their smallest document; those without a string that may repeat are left out.
        low = np.full(len(texts), LAST, dtype=np.int64)
        np.minimum.at(low, code, ords)
        several = repeating(texts)
        hits = {}
        if len(several):
            gone, start = covered_starts([texts[i] for i in several.tolist()], low[several])
            for i, first in zip(several.tolist(), start.tolist()):
                hits[i] = np.flatnonzero(gone[first:first + len(texts[i])])
        none, found = np.zeros(0, dtype=np.int64), []
        for i, c in enumerate(code.tolist()):
            hit = np.arange(size[i] - LENGTH + 1) if ords[i] > low[c] else hits.get(c, none)
            if len(hit):
                found.append((int(rows[i]), int(pos[i]), (hit + int(at[i])).astype(np.int32)))
        return pa.table({"row": pa.array([f[0] for f in found], pa.int64()), "pos": pa.array([f[1] for f in found], pa.int32()),
                         "found": pa.array([f[2] for f in found], pa.list_(pa.int32()))})

    packed, hot = dealt(parts)
    found = packed.groupBy("part").applyInArrow(sort, "row long, pos int, found array<int>")
    if hot is not None:
        found = found.unionByName(covered_by_strings(hot))
    return found.groupBy("row", "pos").agg(F.flatten(F.collect_list("found")).alias("found"))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept)`` for every row: ``kept`` is the remaining bytes (binary)."""
    texts, files = bucketed(_keyed(docs, id_col, text_col))
    parts = stored(pieces(texts, files).withColumn("key", F.substring(F.unhex(F.sha2("data", 256)), 1, 16)),
                   "suffix_pieces", "zstd")
    # Equal pieces once. The pair (row, pos) of hashes names a piece in the sort.
    once = stored(parts.groupBy("key", "data").agg(F.min("ord").alias("ord")).select(
        "key", "ord", F.xxhash64("key").alias("row"), F.hash("key").alias("pos"), "data"), "suffix_once", "zstd")
    known = stored(once.select("key", F.col("ord").alias("low"), "row", "pos")
                   .join(covered(once), ["row", "pos"], "left").select("key", "low", "found"), "suffix_known", "zstd")
    discard(once)
    # A piece of a larger document is covered whole (``n`` bytes), else at the places found (``n`` = 0).
    larger = F.col("ord") > F.col("low")
    gone = parts.select("bucket", "ord", "row", "pos", "key", F.length("data").alias("size")).join(known, "key").filter(
        larger | F.col("found").isNotNull()).select(
            "bucket", "ord", "row", "pos", F.when(larger, F.col("size")).otherwise(0).alias("n"),
            F.when(larger, F.array().cast("array<int>")).otherwise(F.col("found")).alias("found"))
    kind = texts.schema["id"].dataType.simpleString()

    def remove(own, covered):
        import numpy as np
        import pyarrow as pa
        ords, rows = ([t.column(c).to_pylist() for t in (own, covered)] for c in ("ord", "row"))
        of = {}
        for k, name in enumerate(zip(ords[1], rows[1])):
            of.setdefault(name, []).append(k)
        pos, n, found = (covered.column(c).to_pylist() for c in ("pos", "n", "found"))
        out = [], [], [], []
        for data, name in zip(_bytes(own.column("text")), zip(ords[0], rows[0])):
            gone = np.zeros(len(data) + 1, dtype=np.int32)
            for k in of.get(name, ()):
                if n[k]:
                    gone[pos[k]] += 1
                    gone[pos[k] + n[k]] -= 1
                else:
                    at = np.array(found[k], dtype=np.int64) + pos[k]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + LENGTH, -1)
            gone = np.cumsum(gone)[:len(data)] > 0
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            for column, value in zip(out, (len(data), int(gone.sum()), spans, data[~gone].tobytes())):
                column.append(value)
        return pa.table([own.column("id"), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.binary())],
                        names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return texts.groupBy("bucket").cogroup(gone.groupBy("bucket")).applyInArrow(
        remove, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
