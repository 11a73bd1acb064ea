"""Ids of whole texts for a tokenizer that never joins across spaces, from the ids of distinct words.

``word_bpe_49k.json`` drops white space before its merges, so the ids of a text
are the concatenated ids of its space-separated words: exactly, for any text.
The distinct words of a batch are found in Arrow; each is encoded by the
library once and kept in a bounded memo; the texts' ids are gathered in numpy.

ASCII letters are lower-cased and a closing mark is set apart first: the
tokenizer does both, and fewer distinct words are left. Words of letters are
encoded in joined runs (each is one unit of the merges, so the ids split at the
tokens that end a unit); everything else is encoded alone.
"""

from __future__ import annotations

#: A letter, one mark, then white space or the end: every tokenizer here splits before such a mark.
CLOSED = "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])([.,;:!?])([ \n]|\\z)"
SLICE_BYTES = 8 << 20


class WordIds:
    """Encoder over one tokenizer file; ``cap`` bounds the memo."""

    def __init__(self, path: str, cap: int = 500_000):
        import os

        import numpy as np
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.cap = cap
        self.memo = {"": b""}
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token.encode("utf-8")
        self.ends = np.array([t.endswith(b"</w>") for t in self.tokens])

    def _library_ids(self, texts):
        import numpy as np
        return [np.array(e.ids, dtype="<u4") for e in
                self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words):
        """Put the ids of ``words`` into the memo."""
        import numpy as np
        memo = self.memo
        runs = [w for w in words if w.isalpha()]
        alone = [w for w in words if not w.isalpha()]
        for at in range(0, len(runs), 500):
            group = runs[at:at + 500]
            ids, = self._library_ids([" ".join(group)])
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(group):
                raw, start = ids.tobytes(), 0
                for w, stop in zip(group, (stops * 4).tolist()):
                    memo[w] = raw[start:stop]
                    start = stop
            else:  # a letter that the tokenizer does not take for one
                alone += group
        for w, ids in zip(alone, self._library_ids(alone)):
            memo[w] = ids.tobytes()

    def encode(self, texts):
        """``(ids, offsets)`` of an Arrow string array without nulls.

        Text *i* has the ids ``ids[offsets[i]:offsets[i + 1]]``.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # else a special token's string might appear
            texts = pc.ascii_lower(texts)
        texts = pc.replace_substring_regex(texts, CLOSED, "\\1 \\2\\3")
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        coded = lists.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        missing = [w for w in words if w not in self.memo]
        if len(self.memo) + len(missing) > self.cap:
            self.memo.clear()
            self.memo[""] = b""
            missing = [w for w in words if w]
        if missing:
            self._learn(missing)
        parts = [self.memo[w] for w in words]
        pool = np.frombuffer(b"".join(parts), dtype="<u4")
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        starts = np.cumsum(sizes) - sizes
        word_sizes = sizes[codes]
        stops = np.concatenate(([0], np.cumsum(word_sizes)))
        ids = pool[np.repeat(starts[codes] - stops[:-1], word_sizes) + np.arange(stops[-1])]
        word_offsets = lists.offsets.to_numpy().astype(np.int64)
        word_offsets = word_offsets - word_offsets[0]
        return ids, stops[word_offsets]


def slices(texts, most: int = SLICE_BYTES):
    """``(start, stop)`` runs of an Arrow string array of at most ``most`` bytes, or one text."""
    import numpy as np
    import pyarrow.compute as pc
    if not len(texts):
        return
    sums = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = sums[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sums, before + most, side="right")))
        yield start, stop
        start = stop


def strings(column):
    """A batch's column as an Arrow string array; nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "")
