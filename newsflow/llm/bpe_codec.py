"""BPE encoding and decoding with reuse of content-defined chunks.

1. *Chunks*: a rolling hash over the bytes cuts every text where the hash of the
   last ``WINDOW`` bytes has ``CUT_BITS`` zero bits (moved to the next character), so a
   passage that documents share falls into the same chunks wherever it stands.
2. *Reuse*: documents are first brought together by a min-hash of their
   ``WINDOW``-byte strings (a rebalancing exchange: tasks of even size, also when
   one group of copies is a third of the rows). In a task each distinct chunk is
   encoded once and kept in a bounded cache.
3. *Repair*: a join inside a word breaks its ids. The words around the join are
   encoded again by the library, with a neighbouring word on each side; the result
   is taken only if the neighbours' ids agree exactly with those in the chunks on
   both sides, else the text is encoded again as a whole. A join next to white space
   needs no repair (the tokenizer drops white space before its merges).
4. *Decode*: the ids' token strings joined as the library's ``decode`` joins them
   (this tokenizer names no decoder: one space between tokens).

Defined results: NULL text counts as empty (no ids, empty decoding); NULL and
repeated ids are ordinary rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from newsflow.llm.store import worker_cache
from newsflow.llm.word_ids import WordIds, slices, strings

WINDOW = 32
CUT_BITS = 9
CACHE_BYTES = 24 << 20
#: Texts that are encoded at once, and words whose ids are remembered.
SLICE_BYTES = 4 << 20
WORDS = 400_000


def rolling(data):
    """32-bit rolling hash of the last ``WINDOW`` bytes at every byte of a numpy byte array."""
    import numpy as np
    table = np.random.default_rng(20240607).integers(0, 1 << 32, 256, dtype=np.uint32)
    h = table[data]
    width = 1
    while width < WINDOW:
        older = h[:-width] << np.uint32(width)
        h[width:] += older
        width *= 2
    return h


def cut_points(data, starts, stops):
    """Sorted byte positions where chunks start: every text's start and the content-defined cuts."""
    import numpy as np
    h = rolling(data)
    cuts = np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + 1
    if len(cuts):
        text = np.searchsorted(starts, cuts, side="right") - 1
        # The window lies in one text, so the cut depends on that text alone.
        cuts = cuts[(cuts - starts[text] >= WINDOW) & (cuts < stops[text])]
        for _ in range(3):  # to the start of a character (a text's end is one)
            inside = (cuts < len(data)) & ((data[np.minimum(cuts, len(data) - 1)] & 0xC0) == 0x80)
            cuts = cuts + inside
    return np.union1d(cuts, starts[starts < stops])


def buffer_of(texts):
    """``(bytes as numpy array, starts, stops)`` of an Arrow string array."""
    import numpy as np
    import pyarrow as pa
    texts = pa.concat_arrays([texts.cast(pa.string())])  # offset 0
    if texts.offset:
        texts = pa.array(texts.to_pylist(), pa.string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[:len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends[:-1] - ends[0], ends[1:] - ends[0]


def sketch(texts):
    """A min-hash of every text's ``WINDOW``-byte strings (0 for shorter texts)."""
    import numpy as np
    out = np.zeros(len(texts), dtype=np.int64)
    for a, b in slices(texts):
        data, starts, stops = buffer_of(texts.slice(a, b - a))
        if not len(data):
            continue
        h = rolling(data) * np.uint32(2654435761)
        long = np.flatnonzero(stops - starts >= WINDOW)
        bounds = np.stack([starts[long] + WINDOW - 1, stops[long]], axis=1).ravel()
        if len(bounds):
            padded = np.append(h, np.uint32(0xFFFFFFFF))
            out[a + long] = np.minimum.reduceat(padded, bounds)[::2]
    return out


class Codec:
    """Encodes texts chunk by chunk and decodes ids."""

    def __init__(self, path: str):
        self.words = WordIds(path, WORDS)
        self.library = self.words.library
        self.cache, self.held = {}, 0

    def _chunks(self, data, cuts, stops):
        """Per chunk of the buffer its cache entry; new chunks are encoded together, once each."""
        import numpy as np
        import pyarrow as pa
        offsets = np.append(cuts, len(data)).astype(np.int32)
        tiles = pa.StringArray.from_buffers(len(cuts), pa.py_buffer(offsets), pa.py_buffer(data))
        coded = tiles.dictionary_encode()
        texts = coded.dictionary.to_pylist()
        if self.held > CACHE_BYTES:
            self.cache.clear()
            self.held = 0
        entries = [self.cache.get(t) for t in texts]
        new = [i for i, e in enumerate(entries) if e is None]
        if new:
            # The outer two words on either side, whose ids the repairs compare, in the same call.
            fresh = [texts[i] for i in new]
            split = [t.replace("\n", " ").split(" ") for t in fresh]
            edges = [w for s in split for w in (s[0], s[1] if len(s) > 1 else "", s[-2] if len(s) > 1 else "", s[-1])]
            ids, at = self.words.encode(pa.array(fresh + edges, pa.string()))
            sizes = np.diff(at).tolist()
            raw, at, n = ids.tobytes(), at.tolist(), len(fresh)
            for j, i in enumerate(new):
                e = n + 4 * j
                entries[i] = (raw[4 * at[j]:4 * at[j + 1]], len(split[j]), *sizes[e:e + 4])
                self.cache[texts[i]] = entries[i]
                self.held += 5 * len(texts[i]) + 200
        return [entries[c] for c in coded.indices.to_pylist()]

    def _assemble(self, text: bytes, cuts: list, entries: list, windows: list):
        """Parts of one text's ids: bytes, or ``(index into windows, left ids, right ids)``."""
        plain = text.replace(b"\n", b" ")
        parts, done, last = [], 0, len(cuts) - 1
        for j, (ids, words, first, second, before, final) in enumerate(entries):
            start, stop = cuts[j], cuts[j + 1] if j < last else len(text)
            if done >= stop:
                continue
            cut_head = done > start
            low, high = 4 * first * cut_head, len(ids)
            if j == last or plain[stop - 1] == 32 or plain[stop] == 32:
                parts.append(ids[low:high])
                done = stop
                continue
            left, right = plain.rfind(b" ", 0, stop) + 1, plain.find(b" ", stop)
            right = len(text) if right < 0 else right
            context, ahead = b"", b""
            from_, to = left, right
            if left <= max(done, start):
                high = low
            else:
                high = len(ids) - 4 * final
                if words - cut_head >= 2:  # a whole word before the window in this chunk
                    space = plain.rfind(b" ", start, left - 1)
                    from_ = start if space < 0 else space + 1
                    context = ids[high - 4 * before:high]
            if j + 1 <= last and right < len(text):
                end = cuts[j + 2] if j + 2 <= last else len(text)
                word_end = plain.find(b" ", right + 1)
                word_end = len(text) if word_end < 0 else word_end
                whole = word_end < end or (word_end == end and j + 1 == last)
                if right < end and whole:  # a whole word after the window in the next chunk
                    to = word_end
                    nxt = entries[j + 1]
                    ahead = nxt[0][4 * nxt[2]:4 * (nxt[2] + nxt[3])]
            parts.append(ids[low:high])
            parts.append((len(windows), context, ahead))
            windows.append(text[from_:to].decode("utf-8"))
            done = right
        return parts

    def encode(self, texts) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        import numpy as np
        data, starts, stops = buffer_of(texts)
        if not len(data):
            return [b""] * len(texts)
        cuts = cut_points(data, starts, stops)
        entries = self._chunks(data, cuts, stops)
        low, high = np.searchsorted(cuts, starts).tolist(), np.searchsorted(cuts, stops).tolist()
        cuts, raw, windows, planned = cuts.tolist(), data.tobytes(), [], []
        for i, (start, stop) in enumerate(zip(starts.tolist(), stops.tolist())):
            a, b = low[i], high[i]
            planned.append(self._assemble(raw[start:stop], [c - start for c in cuts[a:b]], entries[a:b], windows)
                           if stop > start else [])
        again = [np.array(e.ids, dtype="<u4").tobytes()
                 for e in self.library.encode_batch_fast(windows, add_special_tokens=False)]
        out = []
        for i, parts in enumerate(planned):
            done = []
            for part in parts:
                if isinstance(part, tuple):
                    at, left, right = part
                    ids = again[at]
                    if not (ids.startswith(left) and ids.endswith(right) and len(ids) >= len(left) + len(right)):
                        whole = raw[starts[i]:stops[i]].decode("utf-8")
                        done = [np.array(self.library.encode(whole, add_special_tokens=False).ids, "<u4").tobytes()]
                        break
                    part = ids[len(left):len(ids) - len(right)]
                done.append(part)
            out.append(b"".join(done))
        return out

    def decode(self, ids: bytes) -> bytes:
        import numpy as np
        return b" ".join(map(self.words.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _brought_together(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, __text)``, texts that share strings mostly in the same tasks."""
    @F.arrow_udf("bigint")
    def near(column):
        import pyarrow as pa
        return pa.array(sketch(strings(column)))

    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    return rows.withColumn("__near", near("__text")).hint("rebalance", F.col("__near")).select(id_col, "__text")


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)``: the ids of every text, little-endian unsigned 32-bit integers."""
    rows = _brought_together(docs, id_col, text_col)
    schema = StructType([rows.schema[id_col], StructField("ids", BinaryType())])

    def encode(batches):
        import pyarrow as pa
        codec = worker_cache(("codec", path), lambda: Codec(path))
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts, SLICE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(codec.encode(texts.slice(a, b - a)), pa.binary())],
                    names=schema.names)

    return rows.mapInArrow(encode, schema)


def code_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)``: both directions, digested where they are made."""
    rows = _brought_together(docs, id_col, text_col)
    schema = StructType([rows.schema[id_col], StructField("n_tokens", LongType()),
                         StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])

    def digest(batches):
        from hashlib import sha256

        import pyarrow as pa
        codec = worker_cache(("codec", path), lambda: Codec(path))
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts, SLICE_BYTES):
                ids = codec.encode(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([sha256(x).hexdigest() for x in ids], pa.string()),
                     pa.array([sha256(codec.decode(x)).hexdigest() for x in ids], pa.string())], names=schema.names)

    return rows.mapInArrow(digest, schema)
