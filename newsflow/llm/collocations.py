"""Phrase collocations by weighted acyclic automata.

A *count transducer* accepts phrases of one length word by word; the weights along a phrase's path sum
to its count. It is minimal: equal suffix states are shared, each state's smallest weight is
pushed towards the root first.

1. *Shards*: texts become chunks of at most about ``CHUNK`` words of one language, a written table
   of word ids with each chunk's own sorted word list. Pieces never span chunks.
2. *Filter*, for lengths 2 to 5 in turn: hashes of a chunk's phrases whose two parts passed the round
   before are counted in the chunk, then over all chunks (dealt by hash). Hashes seen often enough enter a bitmap of fixed
   size (``FILTER_BITS``); then the words of such phrases of two words do. A phrase is at most as frequent as its
   parts and its hash, so nothing frequent is left out; an error of the filter costs work, never
   results. (Single words rule out few pairs of words in a large corpus, so they are not counted first.)
3. *Counts*: a shard is some chunks of one task. Its phrases that pass the filter are sorted and counted, and
   count transducers are built from the sorted phrases, in slices of at most ``SLICE`` phrases.
   *Union by prefix range*: phrases drawn from all places of all chunks, in the pass that looks for the words, cut the
   sorted phrases into ranges of about ``RANGE`` entries (as Spark's range partitioner does). A slice ends where
   a range does; a range's transducers are united, weights summed, and what stays
   below the least count goes. A phrase comes once from a shard, so no phrase is hot.
4. *Part lookups by composition*: every candidate asks for the counts of its parts. The requests are cut into
   ranges of (part, candidate), so that a part of very many candidates is spread; a range's requests
   become an acceptor, which is composed with the count transducers that overlap the range.
5. *Scores*: per candidate, the lookups of all cuts meet in one aggregation, with the largest count of
   a phrase one word longer that holds it (if a longer one counts as often, so does one of those
   between). Arithmetic is in decimals of 38 digits. A language's first rows are found per part, then overall.

Defined results: NULL texts are empty, a NULL language is ``und``; text ids are not used, so
repeated rows count again; empty texts and languages without candidates give no rows; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.store import narrow_batches, stored, width

LONGEST = 5
LEAST = 100
TOP = 2000
CHUNK = 500_000
SLICE = 1 << 12
RANGE = 200_000
PART = 500_000  # words of the input per part of the hashed counts
HASH_BITS = 40  # of a phrase's hash that are counted
SHARD = 300_000  # distinct phrases counted together before they leave a task
REQUESTS = 50_000
FILTER_BITS = 1 << 26
BLOCKS = 7  # leading bits of a hash that name its block of the filter
BATCH_BYTES = 2 << 20
DRAWN = 64  # phrases of a range that are offered as boundaries
KEY_BYTES = 64  # of a range boundary; any byte string is a valid one
SLICES = "lang string, k int, first binary, last binary, n long, words binary, word_ends binary, automaton binary"


# --- automata ------------------------------------------------------------------------------

class Builder:
    """A minimal count transducer from sorted phrases, given by their prefixes and last words."""

    def __init__(self, k: int):
        self.k, self.open, self.before = k, [[] for _ in range(max(k - 1, 1))], None
        self.register, self.arcs, self.leaf = {}, [], None

    def _state(self, labels, targets, weights):
        """``(id, weight)``: the registered state of these arcs and what is pushed to the arc that leads to it."""
        least = weights.min()
        weights = weights - least
        key = labels.tobytes() + targets.tobytes() + weights.tobytes()
        if key not in self.register:
            self.arcs.append((labels, targets, weights))
            self.register[key] = len(self.arcs)  # 0 is the final state
        return self.register[key], int(least)

    def _close(self, depth: int):
        """Finish the open state of ``depth`` and hang it below its parent."""
        import numpy as np
        labels, targets, weights = (np.array(x, np.int64) for x in zip(*self.open[depth]))
        self.open[depth] = []
        return self._state(labels, targets, weights)

    def add(self, prefix: tuple, labels, weights) -> None:
        """All phrases that begin with ``prefix`` (``k - 1`` words), which follows the prefixes given so far."""
        import numpy as np
        if self.before is not None:
            same = 0
            while self.before[same] == prefix[same]:
                same += 1
            for depth in range(self.k - 2, same, -1):
                self.open[depth - 1].append((self.before[depth - 1], *self._close(depth)))
        leaf = self._state(labels.astype(np.int64), np.zeros(len(labels), np.int64), weights.astype(np.int64))
        if self.k == 1:
            self.leaf = leaf
        else:
            self.open[self.k - 2].append((prefix[-1], *leaf))
        self.before = prefix

    def done(self) -> dict:
        """The automaton: its arcs by state, in the order of their labels."""
        import numpy as np
        if self.k > 1:
            for depth in range(self.k - 2, 0, -1):
                self.open[depth - 1].append((self.before[depth - 1], *self._close(depth)))
            self.leaf = self._close(0)
        labels, targets, weights = (np.concatenate(x) for x in zip(*self.arcs))
        starts = np.concatenate([[0, 0], np.cumsum([len(a[0]) for a in self.arcs])])  # state 0 has no arcs
        return {"k": self.k, "root": self.leaf[0], "base": self.leaf[1], "starts": starts, "labels": labels,
                "targets": targets, "weights": weights}


def build(rows, weights) -> dict:
    """The automaton of sorted distinct ``rows`` (phrases as word numbers) with their counts."""
    return by_levels(rows, weights) or one_by_one(rows, weights)


def one_by_one(rows, weights) -> dict:
    """The automaton, one phrase prefix after another."""
    import numpy as np
    k = rows.shape[1]
    builder = Builder(k)
    new = np.any(rows[1:, :k - 1] != rows[:-1, :k - 1], axis=1) if k > 1 else np.zeros(max(len(rows) - 1, 0), bool)
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(rows)]
    prefixes = rows[cuts[:-1], :k - 1].tolist()
    for prefix, a, b in zip(prefixes, cuts, cuts[1:]):
        builder.add(tuple(prefix), rows[a:b, k - 1], weights[a:b])
    return builder.done()


def by_levels(rows, weights) -> dict | None:
    """``one_by_one`` for all states of one depth at once, from the last word on. States are told apart by a hash of their
    arcs, then compared; None if two that differ have the same hash."""
    import numpy as np
    n, k = rows.shape
    fresh = np.zeros(n, bool)  # where a prefix of ``depth`` words begins
    begins = []
    for depth in range(k):
        if depth:
            fresh[1:] |= rows[1:, depth - 1] != rows[:-1, depth - 1]
        fresh[0] = True
        begins.append(np.flatnonzero(fresh))
    at, target, weight = np.arange(n), np.zeros(n, np.int64), weights.astype(np.int64)
    arcs, sizes, made = [], [], 0
    for depth in range(k - 1, -1, -1):
        label = rows[at, depth].astype(np.int64)
        first = np.searchsorted(at, begins[depth])
        size = np.diff(first, append=len(at))
        least = np.minimum.reduceat(weight, first)
        weight = weight - np.repeat(least, size)
        place = np.arange(len(at)) - np.repeat(first, size)
        h = np.zeros(len(at), np.uint64)
        for x in (place, label, target, weight):
            h = (h ^ (h >> np.uint64(31)) ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        _, model, same = np.unique(np.add.reduceat(h, first), return_index=True, return_inverse=True)
        if (size != size[model][same]).any():
            return None
        twin = spread(first[model][same], size)
        if any((x != x[twin]).any() for x in (label, target, weight)):
            return None
        own = spread(first[model], size[model])
        arcs.append((label[own], target[own], weight[own]))
        sizes.append(size[model])
        at, target, weight = begins[depth], same + made + 1, least  # 0 is the final state
        made += len(model)
    labels, targets, weights = (np.concatenate(x) for x in zip(*arcs))
    starts = np.concatenate([[0, 0], np.cumsum(np.concatenate(sizes))])  # state 0 has no arcs
    return {"k": k, "root": int(target[0]), "base": int(weight[0]), "starts": starts, "labels": labels,
            "targets": targets, "weights": weights}


def spread(starts, counts):
    """Positions ``starts[i], .., starts[i] + counts[i] - 1`` for all ``i``."""
    import numpy as np
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def paths(a: dict):
    """``(rows, weights)`` of an automaton: its phrases in order, with their counts."""
    import numpy as np
    state, weight, columns = np.array([a["root"]]), np.array([a["base"]]), []
    for _ in range(a["k"]):
        counts = a["starts"][state + 1] - a["starts"][state]
        at = spread(a["starts"][state], counts)
        columns = [np.repeat(c, counts) for c in columns] + [a["labels"][at]]
        weight, state = np.repeat(weight, counts) + a["weights"][at], a["targets"][at]
    return np.stack(columns, axis=1), weight


def compose(acceptor: dict, counts: dict):
    """``(rows, weights)``: the phrases that both automata accept, with the weights of the second."""
    import numpy as np
    states = len(counts["starts"]) - 1
    source = np.repeat(np.arange(states), np.diff(counts["starts"]))
    most = 1 + max([int(counts["labels"].max(initial=0)), int(acceptor["labels"].max(initial=0))])
    keys = source * most + counts["labels"]  # ascending: arcs lie by state, then label
    p, q, weight, columns = np.array([acceptor["root"]]), np.array([counts["root"]]), np.array([counts["base"]]), []
    for _ in range(acceptor["k"]):
        n = acceptor["starts"][p + 1] - acceptor["starts"][p]
        at = spread(acceptor["starts"][p], n)
        label, q, weight = acceptor["labels"][at], np.repeat(q, n), np.repeat(weight, n)
        arc = np.searchsorted(keys, q * most + label)
        hit = arc < len(keys)
        hit[hit] = keys[arc[hit]] == (q * most + label)[hit]
        columns = [np.repeat(c, n)[hit] for c in columns] + [label[hit]]
        arc = arc[hit]
        p, q, weight = acceptor["targets"][at][hit], counts["targets"][arc], weight[hit] + counts["weights"][arc]
    return np.stack(columns, axis=1), weight


def dump(a: dict) -> bytes:
    import pickle

    import numpy as np
    small = lambda x: x.astype(np.uint32) if not len(x) or x.max() < 1 << 32 else x
    return pickle.dumps({k: small(v) if isinstance(v, np.ndarray) else v for k, v in a.items()})


def load(raw: bytes) -> dict:
    import pickle

    import numpy as np
    return {k: v.astype(np.int64) if isinstance(v, np.ndarray) else v for k, v in pickle.loads(raw).items()}


# --- words ---------------------------------------------------------------------------------
# A word is kept with one blank behind it. No word holds a blank, so the order of phrases by their words
# is the order of the joined bytes.

def words_of(data: bytes, ends: bytes) -> list[bytes]:
    import numpy as np
    stops = np.frombuffer(ends, np.int64).tolist()
    return [data[a:b] for a, b in zip([0, *stops], stops)]


def ends_of(words: list[bytes]) -> bytes:
    import numpy as np
    return np.cumsum([len(w) for w in words], dtype=np.int64).tobytes()


def tokenise(texts):
    """``(words, ids)`` of some texts: an Arrow dictionary and its indices, -1 between pieces."""
    import numpy as np
    import pyarrow as pa
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = np.zeros(256, np.uint8)
    kind[list(b" \t")] = 1
    kind[list(b".,;:!?\n\x0b\x0c\r")] = 2
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kinds = kind[data]
    word = kinds == 0
    edge = np.diff(word.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    kept = word.copy()
    kept[ends] = True
    bytes_ = np.where(word, lower[data], 32).astype(np.uint8)[kept]
    offsets = np.concatenate([[0], np.cumsum(ends - starts + 1)]).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()),
                                                             pa.py_buffer(bytes_.tobytes())]).dictionary_encode()
    ids = found.indices.to_numpy()
    marks = np.cumsum(kinds == 2, dtype=np.int32)
    after = np.flatnonzero(np.concatenate([marks[starts[1:]] > marks[ends[:-1] - 1], [True]])) + 1
    return found.dictionary, np.insert(ids, after, -1).astype(np.int32)


def chunks(docs: DataFrame) -> DataFrame:
    """``(lang, n, words, word_ends, ids)``: word numbers of whole texts, -1 between pieces; words sorted."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        held, sizes = {}, {}

        def flush(lang):
            parts, base, ids = held.pop(lang), 0, []
            sizes.pop(lang)
            for d, x in parts:
                ids.append(np.where(x >= 0, x + base, -1))
                base += len(d)
            merged = pa.concat_arrays([d for d, _ in parts]).dictionary_encode()
            words = merged.dictionary.to_pylist()
            order = sorted(range(len(words)), key=words.__getitem__)
            rank = np.empty(len(words), np.int32)
            rank[order] = np.arange(len(words))
            number = rank[merged.indices.to_numpy()]
            ids = np.concatenate(ids)
            ids = np.where(ids >= 0, number[np.maximum(ids, 0)] if len(number) else 0, -1).astype(np.int32)
            words = [words[i] for i in order]
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([int((ids >= 0).sum())], pa.int64()), pa.array([b"".join(words)], pa.binary()),
                 pa.array([ends_of(words)], pa.binary()), pa.array([ids.tobytes()], pa.binary())],
                names=["lang", "n", "words", "word_ends", "ids"])

        def take(lang, texts):
            d, x = tokenise(texts)
            if len(x):
                held.setdefault(lang, []).append((d, x))
                sizes[lang] = sizes.get(lang, 0) + len(x)

        for batch in batches:
            for lang, (texts, size) in _by_language(batch):
                take(lang, texts)
                while sizes.get(lang, 0) >= CHUNK or sum(sizes.values()) >= 2 * CHUNK:
                    yield flush(max(sizes, key=sizes.get))
        for lang in list(held):
            yield flush(lang)

    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.mapInArrow(run, "lang string, n long, words binary, word_ends binary, ids binary")


def _by_language(batch):
    """``(lang, (texts, bytes))`` in groups of about ``BATCH_BYTES``."""
    groups = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        raw = text.as_buffer().to_pybytes() if text.is_valid else b""
        texts, size = groups.get(lang, ([], 0))
        texts.append(raw)
        groups[lang] = texts, size + len(raw)
        if groups[lang][1] >= BATCH_BYTES:
            yield lang, groups.pop(lang)
    yield from groups.items()


# --- counts of one length ------------------------------------------------------------------

def word_hashes(lang: str, words: list[bytes]):
    import numpy as np
    import xxhash
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")) & 0xFFFFFFFF
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def joined(hashes, more):
    """Hash of phrases from the hashes of all words but the last, and of the last."""
    import numpy as np
    h = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + more
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def probes(hashes, bits: int):
    """Three bit positions of each ``HASH_BITS``-bit hash; its leading bits name the block."""
    import numpy as np
    block = bits >> BLOCKS
    mixed = hashes * np.uint64(0x94D049BB133111EB)
    low, high = mixed & np.uint64(0xFFFFFFFF), mixed >> np.uint64(32)
    base = (hashes >> np.uint64(HASH_BITS - BLOCKS)) * np.uint64(block)
    return [(base + (low + np.uint64(i) * (high | np.uint64(1))) % np.uint64(block)).astype(np.int64) for i in range(3)]


def maybe(bitmap, hashes):
    """Whether each hash may be in the filter."""
    import numpy as np
    found = np.ones(len(hashes), bool)
    for p in probes(hashes >> np.uint64(64 - HASH_BITS), len(bitmap) * 8):
        found &= (bitmap[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
    return found


def phrases_at(ids, k: int):
    """Where phrases of ``k`` words begin."""
    import numpy as np
    n = max(len(ids) - k + 1, 0)
    good = np.ones(n, bool)
    for i in range(k):
        good &= ids[i:i + n] >= 0
    return np.flatnonzero(good)


def phrase_hashes(ids, at, k: int, hashes):
    h = hashes[ids[at]]
    for i in range(1, k):
        h = joined(h, hashes[ids[at + i]])
    return h


def shard_rows(ids, at, k: int, words: int):
    """``(rows, counts)``: the sorted distinct phrases of ``k`` words that begin at ``at``."""
    import numpy as np
    columns = [ids[at + i].astype(np.int64) for i in range(k)]
    code, size = columns[0], words
    for c in columns[1:]:
        if size > (1 << 62) // max(words, 1):
            seen, code = np.unique(code, return_inverse=True)
            size = len(seen)
        code, size = code * words + c, size * words
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    return np.stack([c[first] for c in columns], axis=1), counts.astype(np.int64)


def _chunks_of(batches):
    """``(lang, words, their hashes, ids)`` of every chunk."""
    import numpy as np
    for batch in batches:
        for at in range(batch.num_rows):
            lang, words, ends, ids = (batch.column(c)[at].as_py() for c in ("lang", "words", "word_ends", "ids"))
            words = words_of(words, ends)
            yield lang, words, word_hashes(lang, words), np.frombuffer(ids, np.int32)


def planes(x) -> bytes:
    """Ascending 64-bit numbers as byte planes of their differences (the upper planes are mostly zero)."""
    import numpy as np
    return np.diff(x, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(raw: bytes):
    import numpy as np
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def frequent_hashes(chunked: DataFrame, k: int, least: int, parts: int, bitmap=None) -> DataFrame:
    """``(block, hashes)``: hashes of phrases of ``k`` words that occur ``least`` times or more and whose two parts,
    where they have two words at least, are in the filter."""
    shift = parts.bit_length() - 1

    def count(batches):
        import numpy as np
        import pyarrow as pa
        bits = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        for _, _, hashes, ids in _chunks_of(batches):
            at = phrases_at(ids, k)
            for first in (0, 1) if bits is not None else ():
                at = at[maybe(bits, phrase_hashes(ids, at + first, k - 1, hashes))]
            seen, counts = np.unique(phrase_hashes(ids, at, k, hashes) >> np.uint64(64 - HASH_BITS), return_counts=True)
            part = (seen >> np.uint64(HASH_BITS - shift)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
            pieces = list(zip(cuts, [*cuts[1:], len(seen)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cuts]), pa.array([planes(seen[a:b]) for a, b in pieces], pa.binary()),
                 pa.array([counts[a:b].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a, b in pieces],
                          pa.binary())], names=["part", "hashes", "counts"])

    def add(key, table):
        import numpy as np
        import pyarrow as pa
        hashes = np.concatenate([from_planes(r) for r in table.column("hashes").to_pylist()])
        counts = np.concatenate([np.ascontiguousarray(np.frombuffer(r, np.uint8).reshape(4, -1).T).view("<u4").ravel()
                                 for r in table.column("counts").to_pylist()]).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
        new = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        hashes = hashes[new][np.add.reduceat(counts, new) >= least]
        return _by_block(hashes, pa.Table.from_arrays)

    counted = chunked.mapInArrow(count, "part long, hashes binary, counts binary")
    return counted.groupBy("part").applyInArrow(add, "block long, hashes binary")


def part_words(chunked: DataFrame, longest: int, bitmap) -> DataFrame:
    """``(block, hashes)``: the words of phrases of two words that are in the filter; and rows ``(lang, k, key)``: of
    every chunk's phrases that will be counted, one in ``DRAWN``, chosen by hash and not by how often they occur."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        bits = np.frombuffer(bitmap.value, np.uint8)
        every = max(1, RANGE // DRAWN)
        for lang, words, hashes, ids in _chunks_of(batches):
            at = phrases_at(ids, 2)
            at = at[maybe(bits, phrase_hashes(ids, at, 2, hashes))]
            found = np.unique(np.concatenate([ids[at], ids[at + 1]]))
            used = _by_block(np.unique(hashes[found] >> np.uint64(64 - HASH_BITS)), pa.RecordBatch.from_arrays)
            none = [pa.nulls(used.num_rows, t) for t in (pa.string(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*used.columns, *none], names=names)
            rest = np.uint64(len(ids) % every)  # another one for each chunk
            for k in range(1, longest + 1):
                begin = found if k == 1 else at if k == 2 else phrases_at(ids, k)
                h = hashes[found] if k == 1 else phrase_hashes(ids, begin, k, hashes)
                drawn = np.flatnonzero(h % np.uint64(every) == rest)
                if k > 2:
                    drawn = drawn[maybe(bits, h[drawn])]
                begin = begin[drawn[np.unique(h[drawn], return_index=True)[1]]]
                rows = begin[:, None] if k == 1 else ids[begin[:, None] + np.arange(k)]
                keys = [b"".join(words[i] for i in row)[:KEY_BYTES] for row in rows.tolist()]
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array([lang] * n, pa.string()),
                     pa.array([k] * n, pa.int32()), pa.array(keys, pa.binary())], names=names)

    names = ["block", "hashes", "lang", "k", "key"]
    return chunked.mapInArrow(run, "block long, hashes binary, lang string, k int, key binary")


def _by_block(hashes, make):
    """``(block, hashes)`` rows of ascending hashes, by ``make``."""
    import numpy as np
    import pyarrow as pa
    block = (hashes >> np.uint64(HASH_BITS - BLOCKS)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(block, prepend=-1)).tolist()
    return make([pa.array(block[cuts]), pa.array([planes(hashes[a:b]) for a, b in zip(cuts, [*cuts[1:], len(hashes)])],
                                                 pa.binary())], names=["block", "hashes"])


def add_to_filter(bitmap: bytearray, frequent: DataFrame) -> bool:
    """Put the hashes into ``bitmap`` (its blocks are made by the tasks); whether there were any."""
    bits, block = len(bitmap) * 8, len(bitmap) >> BLOCKS

    def make(key, table):
        import numpy as np
        import pyarrow as pa
        own = np.zeros(block, np.uint8)
        for raw in table.column("hashes").to_pylist():
            for p in probes(from_planes(raw), bits):
                np.bitwise_or.at(own, (p >> 3) - key[0].as_py() * block, np.uint8(1) << (p & 7).astype(np.uint8))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([own.tobytes()], pa.binary())})

    import numpy as np
    found = frequent.groupBy("block").applyInArrow(make, "block long, bits binary").collect()
    whole = np.frombuffer(bitmap, np.uint8)
    for r in found:
        whole[r["block"] * block:(r["block"] + 1) * block] |= np.frombuffer(r["bits"], np.uint8)
    return bool(found)


def slices_of(lang: str, words: list[bytes], rows, counts):
    """Record batches of ``SLICES``: count transducers of at most ``SLICE`` sorted phrases."""
    import numpy as np
    import pyarrow as pa
    k = rows.shape[1]
    for at in range(0, len(rows), SLICE):
        part = rows[at:at + SLICE]
        used, local = np.unique(part, return_inverse=True)
        own = [words[i] for i in used.tolist()]
        local = local.reshape(part.shape)
        ends = [b"".join(own[i] for i in row) for row in (local[0].tolist(), local[-1].tolist())]
        last = ends[1] if len(ends[1]) <= KEY_BYTES else ends[1][:KEY_BYTES] + b"\xff"
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang], pa.string()), pa.array([k], pa.int32()), pa.array([ends[0][:KEY_BYTES]], pa.binary()),
             pa.array([last], pa.binary()), pa.array([len(part)], pa.int64()), pa.array([b"".join(own)], pa.binary()),
             pa.array([ends_of(own)], pa.binary()), pa.array([dump(build(local, counts[at:at + SLICE]))], pa.binary())],
            names=["lang", "k", "first", "last", "n", "words", "word_ends", "automaton"])


def summed(parts: list):
    """``(words, rows, counts)`` of several counts ``(words, rows, counts)`` of phrases of one length, sorted."""
    import numpy as np
    words, numbers = common([w for w, _, _ in parts])
    rows = np.concatenate([number[r] for number, (_, r, _) in zip(numbers, parts)])
    counts = np.concatenate([c for _, _, c in parts])
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], np.any(rows[1:] != rows[:-1], axis=1)]))
    return words, rows[new], np.add.reduceat(counts, new)


def shard_counts(chunked: DataFrame, longest: int, bitmap, bounds: list[tuple]) -> DataFrame:
    """``SLICES`` and ``range`` of every shard: counts of its own phrases of up to ``longest`` words that pass the filter.

    Range ``i`` holds the keys from bound ``i - 1`` on, below bound ``i``.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        bits = np.frombuffer(bitmap.value, np.uint8)
        held, size = {}, 0

        def flush():
            for (lang, k), parts in sorted(held.items()):
                words, rows, counts = summed(parts)
                a, b = (bisect_left(bounds, (lang, x)) for x in (k, k + 1))
                stops = [0, *(_position(rows, words, (lang, k), bound) for bound in bounds[a:b]), len(rows)]
                made = [(at, piece) for at, (x, y) in enumerate(zip(stops, stops[1:]), a)
                        for piece in slices_of(lang, words, rows[x:y], counts[x:y])]
                table = pa.Table.from_batches([piece for _, piece in made]).append_column(
                    "range", pa.array([at for at, _ in made], pa.int64()))
                yield from table.combine_chunks().to_batches()
            held.clear()

        for lang, words, hashes, ids in _chunks_of(batches):
            for k in range(1, longest + 1):
                at = phrases_at(ids, k)
                at = at[maybe(bits, phrase_hashes(ids, at, k, hashes))]
                if len(at):
                    rows, counts = shard_rows(ids, at, k, len(words))
                    used, local = np.unique(rows, return_inverse=True)
                    held.setdefault((lang, k), []).append(([words[i] for i in used.tolist()], local.reshape(rows.shape), counts))
                    size += len(rows)
            if size >= SHARD:
                for key, parts in held.items():
                    held[key] = [summed(parts)]
                size = sum(len(parts[0][1]) for parts in held.values())
                if size >= SHARD // 2:
                    yield from flush()
                    size = 0
        yield from flush()

    return chunked.mapInArrow(run, SLICES + ", range long")


def _sampled(rows: DataFrame, columns: list[str], parts: int, weight: str = "1") -> list[tuple]:
    """At most ``parts - 1`` boundaries: quantiles of a sample of ``8 * parts`` rows, drawn by weight.

    Equal rows are drawn independently: a sample by their hash would be of distinct rows, however many are equal.
    """
    if parts < 2:
        return []
    drawn = F.expr(f"ln(1D - rand(7)) / ({weight})")
    sample = rows.orderBy(drawn.desc()).select(*columns).limit(8 * parts).collect()
    keys = sorted(tuple(bytes(x) if isinstance(x, (bytes, bytearray)) else x for x in r) for r in sample)
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def overlapping(slices: DataFrame, bounds: list[tuple]) -> DataFrame:
    """``slices`` with the number ``range`` of each range that they have keys in: range ``i`` holds the keys
    from bound ``i - 1`` on, below bound ``i``."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for i, r in enumerate(zip(*(batch.column(n).to_pylist() for n in ("lang", "k", "first", "last")))):
                a = bisect_right(bounds, (*slice_key(r, 2), ""))
                b = bisect_right(bounds, (*slice_key(r, 3), "\U0010ffff"))
                same = pa.Table.from_batches([batch.slice(i, 1)])
                for at in range(a, b + 1):
                    yield from same.append_column("range", pa.array([at], pa.int64())).to_batches()

    return slices.mapInArrow(run, SLICES + ", range long")


def _position(rows, words, group, bound) -> int:
    """How many of the sorted phrases of ``group`` lie below ``bound``."""
    class Keys:
        def __len__(self):
            return len(rows)

        def __getitem__(self, i):
            return *group, b"".join(words[j] for j in rows[i].tolist())
    return bisect_left(Keys(), bound)


def slice_key(row, end: int):
    """``(lang, k, key)`` of a slice's first (2) or last (3) phrase."""
    return row[0], row[1], bytes(row[end])


def common(words: list):
    """``(all words sorted, numbers)``: the numbers of each list's (or Arrow array's) words in the sorted union."""
    import numpy as np
    import pyarrow as pa
    sizes = [len(w) for w in words]
    encoded = pa.concat_arrays([w if isinstance(w, pa.Array) else pa.array(w, pa.binary()) for w in words]).dictionary_encode()
    distinct = encoded.dictionary.to_pylist()
    order = sorted(range(len(distinct)), key=distinct.__getitem__)
    rank = np.empty(len(distinct), np.int64)
    rank[order] = np.arange(len(distinct))
    numbers = rank[encoded.indices.to_numpy()] if len(encoded) else np.zeros(0, np.int64)
    return [distinct[i] for i in order], np.split(numbers, np.cumsum(sizes)[:-1])


def word_array(data: bytes, ends: bytes):
    """The words as an Arrow array (a slice's words are far below 2 GB)."""
    import numpy as np
    import pyarrow as pa
    stops = np.concatenate([[0], np.frombuffer(ends, np.int64)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(stops) - 1, [None, pa.py_buffer(stops.tobytes()), pa.py_buffer(data)])


def united(slices: DataFrame, least: int) -> DataFrame:
    """``SLICES``: per range, the union of the transducers with weights summed, phrases below ``least`` left out."""
    def run(key, table):
        import numpy as np
        import pyarrow as pa
        by, made = {}, []
        for r in table.select(["lang", "k", "words", "word_ends", "automaton"]).to_pylist():
            by.setdefault((r["lang"], r["k"]), []).append(r)
        for (lang, k), rs in sorted(by.items()):
            words, rows, weights = summed([(word_array(r["words"], r["word_ends"]), *paths(load(r["automaton"]))) for r in rs])
            often = weights >= least
            made += slices_of(lang, words, rows[often], weights[often])
        return pa.Table.from_batches(made) if made else table.slice(0, 0).drop_columns(["range"])

    return slices.groupBy("range").applyInArrow(run, SLICES)


def phrase_counts(chunked: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``SLICES`` of all phrases of 2 to ``longest`` words that occur ``least`` times or more, and of their words."""
    sc, bitmap, sent = chunked.sparkSession.sparkContext, bytearray(FILTER_BITS // 8), None
    n = chunked.agg(F.sum("n")).first()[0] or 0
    parts = 1 << (n // PART).bit_length()
    for k in range(2, longest + 1):
        if not add_to_filter(bitmap, frequent_hashes(chunked, k, least, parts, sent)):
            break  # no longer phrase is frequent either
        sent = sc.broadcast(bytes(bitmap))
    bounds = []
    if sent:
        words = stored(part_words(chunked, longest, sent), "phrase_words", "zstd")
        add_to_filter(bitmap, words.filter("block IS NOT NULL").select("block", "hashes"))
        keys = words.filter("block IS NULL").select("lang", "k", "key")
        bounds = _sampled(keys, keys.columns, -(-keys.count() // DRAWN))
    shards = shard_counts(chunked, longest, sc.broadcast(bytes(bitmap)), bounds)
    return stored(united(shards, least), "frequent_phrases")


# --- part lookups and scores ---------------------------------------------------------------

LOOKUPS = "lang string, k int, part binary, phrase string, words int, a long, cut int, side int"


def lookups(counts: DataFrame) -> DataFrame:
    """``LOOKUPS``: for each candidate and cut its two parts (side 0 and 1); for each phrase one word shorter
    that it holds, its own count (side 2; cut 0)."""
    def run(batches):
        import pyarrow as pa
        types = [pa.string(), pa.int32(), pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
        names = [c.split()[0] for c in LOOKUPS.split(", ")]
        for batch in batches:
            for r in batch.to_pylist():
                words, k = words_of(r["words"], r["word_ends"]), r["k"]
                rows, weights = paths(load(r["automaton"]))
                out = []
                for row, a in zip(rows.tolist(), weights.tolist()):
                    ws = [words[i] for i in row]
                    phrase = b"".join(ws)[:-1].decode()
                    for cut in range(1, k):
                        out.append((r["lang"], cut, b"".join(ws[:cut]), phrase, k, a, cut, 0))
                        out.append((r["lang"], k - cut, b"".join(ws[cut:]), phrase, k, a, cut, 1))
                    if k > 2:
                        for part in (ws[:-1], ws[1:]):
                            out.append((r["lang"], k - 1, b"", b"".join(part)[:-1].decode(), k - 1, a, 0, 2))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)

    return counts.filter("k > 1").select("lang", "k", "words", "word_ends", "automaton").mapInArrow(run, LOOKUPS)


def part_counts(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """``asked`` with the count ``f`` of every part, by composition."""
    held = counts.agg(F.sum("n")).first()[0] or 0
    keys = asked.select("lang", "k", F.expr(f"substring(part, 1, {KEY_BYTES})").alias("key"), "phrase")
    firsts = counts.select("lang", "k", F.col("first").alias("key"), F.lit("").alias("phrase"), "n")
    bounds = sorted({*_sampled(keys, keys.columns, -(-asked.count() // REQUESTS)),
                     *_sampled(firsts, firsts.columns[:-1], -(-held // RANGE), "n")})
    schema = "lang string, phrase string, words int, a long, cut int, side int, f long"

    def run(key, requests, slices):
        import numpy as np
        import pyarrow as pa
        rs = requests.to_pylist()
        found = {}
        asked_for = {}
        for r in rs:
            asked_for.setdefault((r["lang"], r["k"]), set()).add(r["part"])
        asked_for = {g: sorted(ps) for g, ps in asked_for.items()}
        for s in slices.to_pylist():
            group = s["lang"], s["k"]
            wanted = asked_for.get(group, [])
            lo, hi = bisect_left(wanted, s["first"]), bisect_right(wanted, s["last"] + b"\xff")
            if lo == hi:
                continue
            split = [[w + b" " for w in p[:-1].split(b" ")] for p in wanted[lo:hi]]
            own = words_of(s["words"], s["word_ends"])
            words, (mine, theirs) = common([sorted({w for ws in split for w in ws}), own])
            number = {w: i for i, w in enumerate(words)}
            rows = np.array([[number[w] for w in ws] for ws in split], np.int64)
            automaton = load(s["automaton"])
            automaton["labels"] = theirs[automaton["labels"]]  # in the common numbers, still ascending
            got, weights = compose(build(rows, np.zeros(len(rows), np.int64)), automaton)
            found.update({(*group, b"".join(words[i] for i in row)): w for row, w in zip(got.tolist(), weights.tolist())})
        cols = ["lang", "phrase", "words", "a", "cut", "side"]
        out = requests.select(cols)
        return out.append_column("f", pa.array([found.get((r["lang"], r["k"], r["part"])) for r in rs], pa.int64()))

    # A request's key is (part, phrase); a slice overlaps every range that holds a request for one of its phrases.
    requests = _ranged_requests(asked, bounds)
    held = stored(overlapping(counts, bounds), "ranged_phrases")
    return requests.groupBy("range").cogroup(held.groupBy("range")).applyInArrow(run, schema)


def _ranged_requests(asked: DataFrame, bounds: list[tuple]) -> DataFrame:
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            keys = zip(*(batch.column(n).to_pylist() for n in ("lang", "k", "part", "phrase")))
            at = [bisect_right(bounds, (lang, k, part[:KEY_BYTES], phrase)) for lang, k, part, phrase in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=[*batch.schema.names, "range"])

    return asked.mapInArrow(run, LOOKUPS + ", range long")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases by score, count and text."""
    spark = docs.sparkSession
    with narrow_batches(spark):  # chunks and slices are large rows
        chunked = stored(chunks(docs), "phrase_chunks", "zstd")
        counts = phrase_counts(chunked, longest, least)
        wanted = stored(lookups(counts), "part_lookups")
        found = part_counts(wanted.filter("side < 2"), counts)
    total = chunked.groupBy("lang").agg(F.sum("n").alias("n"))
    answers = found.unionByName(
        wanted.filter("side = 2").select("lang", "phrase", "words", F.lit(None).cast("long").alias("a"), "cut", "side",
                                         F.col("a").alias("f")))
    part = lambda cut, side: F.max(F.when((F.col("cut") == cut) & (F.col("side") == side), F.col("f")))
    cuts = range(1, longest)
    lists = answers.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.max("words").alias("words"), F.max(F.when(F.col("side") == 2, F.col("f"))).alias("longer"),
        *[part(c, 0).alias(f"l{c}") for c in cuts], *[part(c, 1).alias(f"r{c}") for c in cuts])
    # A phrase that is only asked about as a part of itself has no count of its own.
    lists = lists.filter("a IS NOT NULL AND (longer IS NULL OR 100 * longer < 100 * a)").join(total, "lang")
    score = lambda c: F.expr(
        f"CAST((CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0))) "
        f"div (CAST(l{c} AS DECIMAL(19,0)) * CAST(r{c} AS DECIMAL(19,0))) AS BIGINT)")
    options = F.array(*[F.when(F.col("words") > c, F.struct(score(c).alias("score"), F.lit(c).alias("cut"),
                                                            F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")))
                        for c in cuts])
    scored = lists.withColumn("best", F.array_min(F.filter(options, lambda x: x.isNotNull()))).select(
        "lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # A language may hold most phrases: the first rows of each part, then of the language.
    parts = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(width(spark))))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(
        F.col("rank") <= top)
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
