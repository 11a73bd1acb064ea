"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are made.

A unit (what the tokenizer's own split gives) starts as a linked list of its
bytes' symbols. A heap holds the adjacent pairs that have a merge rank; the
lowest rank (leftmost on ties) is popped, merged, and the two new pairs pushed;
stale entries are dropped when popped. Count = initial symbols - merges.

Texts are cut into pieces that the tokenizer treats alike in any text (a run of
non-space with the space or line end before it, less a closing mark); the distinct pieces of a batch
are found in Arrow and each is merged once (a bounded memo per worker). Texts
with white space that such a cut would not keep apart (three or more in a row,
two at the end, other white space), or with a special token's string, take the
tokenizer's split over the whole text. One map over the input: no shuffle.

Defined results: NULL text counts as empty (0 bytes, 0 tokens); NULL and
repeated ids are ordinary rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from newsflow.llm.store import worker_cache
from newsflow.llm.word_ids import CLOSED, slices, strings

#: Fixed value: the unit pattern of the byte-level vocabularies.
UNITS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Below this code point the pattern library and the tokenizer agree on letters, numbers and white space.
AGREED = "\u0530"
#: The white space other than blank and line end, as a character class.
OTHER_SPACE = "\t\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def merges(symbols: list, ranks: dict) -> int:
    """Number of merges that byte-pair merging makes on ``symbols``."""
    from heapq import heapify, heappop, heappush
    n = len(symbols)
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks]
    if not heap:
        return 0
    heapify(heap)
    symbols = [*symbols, None]
    after, before, done = list(range(1, n + 1)), list(range(-1, n)), 0
    while heap:
        rank, i = heappop(heap)
        left = symbols[i]
        j = after[i] if left is not None else n
        if j >= n or ranks.get((left, symbols[j])) != rank:
            continue
        done += 1
        joined = symbols[i] = left + symbols[j]
        symbols[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get((joined, symbols[k]))
            if rank is not None:
                heappush(heap, (rank, i))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbols[h], joined))
            if rank is not None:
                heappush(heap, (rank, h))
    return done


class Counter:
    """Counts tokens as the byte-level tokenizer in file ``path`` makes them."""

    def __init__(self, path: str, cap: int = 1_000_000):
        import json

        import regex
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i
                      for i, m in enumerate(spec["model"]["merges"])}
        self.split = Tokenizer.from_file(path).pre_tokenizer
        # The byte-to-symbol table, read off the tokenizer's own split.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.symbol = {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(rest)}}
        self.units = regex.compile(UNITS)
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.specials = set(specials)
        self.uneven = ("[ \n]{3}|[ \n]{2}\\z|[\x00" + OTHER_SPACE + "]"
                       + "".join("|" + regex.escape(s) for s in specials))
        self.memo, self.cap = {"": 0}, cap

    def unit(self, text: str) -> int:
        symbols = [self.symbol[b] for b in text.encode("utf-8")]
        return len(symbols) - merges(symbols, self.ranks)

    def piece(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if max(text, default="") < AGREED:
            return sum(map(self.unit, self.units.findall(text)))
        total = 0
        for symbols, _ in self.split.pre_tokenize_str(text):
            total += len(symbols) - merges(list(symbols), self.ranks)
        return total

    def whole(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        return sum(1 if p in self.specials else self._long(p) for p in parts)

    def _long(self, text: str) -> int:
        plain = max(text, default="") < AGREED
        if not plain:
            return self.piece(text)
        memo, total = self.memo, 0
        for unit in self.units.findall(text):
            n = memo.get(unit)
            if n is None:
                n = memo[unit] = self.unit(unit)
            total += n
        return total

    def count(self, texts):
        """Token counts of an Arrow string array without nulls."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if len(self.memo) > self.cap:
            self.memo.clear()
            self.memo[""] = 0
        uneven = pc.match_substring_regex(texts, self.uneven).to_numpy(zero_copy_only=False)
        even = pc.if_else(pa.array(uneven), pa.scalar("", texts.type), texts)
        marked = pc.replace_substring_regex(even, CLOSED, "\\1\x00\\2\\3")
        marked = pc.replace_substring(pc.replace_substring(marked, " ", "\x00 "), "\n", "\x00\n")
        lists = pc.split_pattern(marked, "\x00")
        coded = lists.flatten().dictionary_encode()
        memo, counts = self.memo, []
        for p in coded.dictionary.to_pylist():
            n = memo.get(p)
            if n is None:
                n = self.piece(p)
                memo[p] = n
            counts.append(n)
        each = np.array(counts, dtype=np.int64)[coded.indices.to_numpy()] if counts else np.zeros(0, np.int64)
        sums = np.concatenate(([0], np.cumsum(each)))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        out = sums[offsets[1:]] - sums[offsets[:-1]]
        for i in np.flatnonzero(uneven):
            out[i] = self.whole(texts[int(i)].as_py())
        return out


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    schema = StructType([rows.schema[id_col], StructField("n_bytes", LongType()), StructField("n_tokens", LongType()),
                         StructField("over_limit", BooleanType())])

    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        counter = worker_cache(("token counter", path), lambda: Counter(path))
        for batch in batches:
            texts = strings(batch.column(1))
            parts = [counter.count(texts.slice(a, b - a)) for a, b in slices(texts)]
            tokens = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(tokens),
                 pa.array(tokens > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(count, schema)
