"""Token counts, encoding and packing against the tokenizers library."""

import random
from collections import Counter, defaultdict
from hashlib import sha256
from struct import pack
from zlib import crc32

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from newsflow.llm import bpe_codec, packing, token_count
from newsflow.llm.queries import tokenizer
from newsflow.llm.word_ids import WordIds
from tests.llm.conftest import TEXTS

ODD = ["", "a", " ", "  a", "a   b", "x\n\ny", "end  ", "end\n\n", "tab\there", "a<|endoftext|> b <|endoftext|>",
       "<|ENDOFTEXT|>", "it's we'll I'd  'sx", "…—“q” ’s", "日本語 テスト" * 40, "Α Σ ς İ ﬁ", "a\x00b", "a\x1cb",
       "́x é", "１２３ 45", "x" * 5000, "ab" * 3000 + " tail", "foo,bar. baz?! (a), ...b", "a b c",
       "🎉🎉 ok" * 50, "\r\nfoo\r\n", "don't, stop. U.S.A. " * 60, "é" * 300, "İΣ"]


@pytest.fixture(scope="module")
def texts():
    import duckdb
    rng = random.Random(2)
    real = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    mixed = ["".join(rng.choice([*ODD, " ", "\n", ".", ",", "<|"]) for _ in range(6)) for _ in range(300)]
    return real + ODD + mixed


def library(name, texts):
    return [e.ids for e in Tokenizer.from_file(tokenizer(name)).encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(texts):
    counter = token_count.Counter(tokenizer("byte_bpe_50k.json"))
    assert counter.count(pa.array(texts)).tolist() == [len(i) for i in library("byte_bpe_50k.json", texts)]
    counter.cap = 0  # the memo is dropped before every batch
    assert counter.count(pa.array(texts)).tolist() == [len(i) for i in library("byte_bpe_50k.json", texts)]


def test_merges_pop_the_lowest_rank_leftmost():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2, ("a", "a"): 3}
    assert token_count.merges(list("abc"), ranks) == 2 and token_count.merges(list("aaaa"), ranks) == 2
    assert token_count.merges([], ranks) == 0 and token_count.merges(["a"], ranks) == 0


def test_word_ids_equal_the_library(texts):
    ids, at = WordIds(tokenizer("word_bpe_49k.json"), cap=3000).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == library("word_bpe_49k.json", texts)


@pytest.mark.parametrize("bits", [9, 4, 2])
def test_codec_equals_the_library(texts, bits, monkeypatch):
    monkeypatch.setattr(bpe_codec, "CUT_BITS", bits)  # short chunks: joins inside almost every word
    codec = bpe_codec.Codec(tokenizer("word_bpe_49k.json"))
    got, want = codec.encode(pa.array(texts)), library("word_bpe_49k.json", texts)
    assert [list(memoryview(g).cast("I")) if g else [] for g in got] == want
    for g, w in list(zip(got, want))[::7]:
        assert codec.decode(g).decode() == codec.library.decode(w, skip_special_tokens=False)


def test_shared_passage_shares_chunks():
    """Chunks are set by content: a passage falls into the same chunks wherever it stands."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(2000))
    chunks = []
    for before in ("", "some words before it "):
        data, starts, stops = bpe_codec.buffer_of(pa.array([before + passage]))
        cuts = bpe_codec.cut_points(data, starts, stops).tolist()
        chunks.append({data.tobytes()[a:b] for a, b in zip(cuts, cuts[1:])})
    assert len(chunks[0]) > 10 and len(chunks[0] & chunks[1]) >= len(chunks[0]) - 1


def test_queries_on_edge_rows(edge, empty):
    plain = [(i, t or "") for i, t in TEXTS]
    ids = library("word_bpe_49k.json", [t for _, t in plain])
    decode = Tokenizer.from_file(tokenizer("word_bpe_49k.json")).decode
    want = Counter((i, len(x), sha256(pack(f"<{len(x)}I", *x)).hexdigest(),
                    sha256(decode(x, skip_special_tokens=False).encode()).hexdigest()) for (i, _), x in zip(plain, ids))
    got = bpe_codec.code_digests(edge, tokenizer("word_bpe_49k.json"))
    assert Counter(tuple(r) for r in got.collect()) == want
    coded = bpe_codec.encode_documents(edge, tokenizer("word_bpe_49k.json")).collect()
    assert Counter((r.doc_id, bytes(r.ids)) for r in coded) == Counter(
        (i, pack(f"<{len(x)}I", *x)) for (i, _), x in zip(plain, ids))
    counts = [len(x) for x in library("byte_bpe_50k.json", [t for _, t in plain])]
    got = token_count.token_counts(edge, tokenizer("byte_bpe_50k.json"), limit=100)
    assert Counter(tuple(r) for r in got.collect()) == Counter(
        (i, len(t.encode()), n, n > 100) for (i, t), n in zip(plain, counts))
    assert bpe_codec.code_digests(empty, tokenizer("word_bpe_49k.json")).count() == 0
    assert token_count.token_counts(empty, tokenizer("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("capacity", [4096, 16])
def test_packing(edge, capacity):
    got = packing.pack_documents(edge, tokenizer("word_bpe_49k.json"), capacity=capacity).collect()
    want = Counter()
    for (i, _), x in zip(TEXTS, library("word_bpe_49k.json", [t or "" for _, t in TEXTS])):
        x = [*x, 1]
        for k, start in enumerate(range(0, len(x), capacity)):
            part = x[start:start + capacity]
            want[(i, k, start, len(part), crc32(pack(f"<{len(part)}I", *part)))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_a_length_that_most_pieces_have(spark):
    """One length in every part, others beside it: each piece gets a place of its own, in as few sequences as the plan says."""
    from pyspark.sql import functions as F
    from newsflow.llm.store import stored
    rows = spark.range(0, 20_000, 1, 40).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"),
        F.when(F.col("id") % 10 < 9, F.lit(30)).otherwise(F.col("id") % 97 + 1).cast("long").alias("length"),
        F.spark_partition_id().alias("part"))
    measured = rows.rdd.mapPartitions(numbered).toDF("doc_id long, piece int, length long, part int, nth long")
    placed = packing.place(stored(measured, "test_measured"), 100)
    assert placed.columns == ["doc_id", "piece", "length", "sequence_id", "offset"]
    got = placed.collect()
    assert len({r.doc_id for r in got}) == len(got) == 20_000
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 100
    assert len(places) >= -(-sum(r.length for r in got) // 100)
    last = max(places)
    assert sorted(places) == list(range(last + 1))


def numbered(rows):
    seen = Counter()
    for r in rows:
        yield (r.doc_id, r.piece, r.length, r.part, seen[r.length])
        seen[r.length] += 1


def test_packing_empty(empty):
    assert packing.pack_documents(empty, tokenizer("word_bpe_49k.json")).count() == 0


def test_plan_is_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(200):
        capacity = rng.choice([10, 50, 100])
        counts = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(1, 12))}
        rooms = []  # best fit, piece by piece
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                fits = [k for k, room in enumerate(rooms) if room >= length]
                if fits:
                    rooms[min(fits, key=lambda k: rooms[k])] -= length
                else:
                    rooms.append(capacity - length)
        slots = sorted(packing.plan(counts, capacity))
        filled = defaultdict(list)
        for k, (length, rank, first, per, offset) in enumerate(slots):
            stop = slots[k + 1][1] if k + 1 < len(slots) and slots[k + 1][0] == length else counts[length]
            for r in range(rank, stop):
                filled[first + (r - rank) // per].append((offset + (r - rank) % per * length, length))
        assert len(filled) == len(rooms)
        assert sorted(capacity - sum(n for _, n in parts) for parts in filled.values()) == sorted(rooms)
