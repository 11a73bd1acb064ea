"""N-gram Jaccard join by chosen paths.

A document's set is its distinct runs of ``WORDS`` words (lower case, letters and
digits; a text of fewer words is one run). Documents with equal sets are one
*class*; the join runs over classes, and copies are never expanded into pairs.

1. *Paths*: in every run, each level samples one token of a set (the set's
   minimum under that run's and level's hash), the same token for two sets with
   probability equal to their similarity. A bucket is the sets that share a path.
2. *Split*: a bucket of one set is dropped, a bucket of up to ``SMALL`` sets is compared by brute
   force (min-hash agreement, far below the threshold), a larger one is split by
   the next level's token. What is still large after ``DEPTH`` levels agrees on that many
   samples: it is taken as linked for now, without making its pairs.
3. *Repeat*: a pair at the threshold survives a run with probability
   ``t ** DEPTH`` at least; ``runs_for`` gives the number of runs for the target recall.
   All runs use the same samples, so a pair below the brute force's floor is lost in
   every one: ``least_equal`` sets the floor so that both losses stay within the target.
4. *Verify*: the candidate links' components bring sets together. Within a
   component all pairs are compared exactly on the sets, in tiles of bounded
   blocks; a tile returns per set its number of links and one spanning link, so a
   group of any size emits rows in proportion to its members, not its pairs.

The result is one row per document: its class id (the smallest document id that
is linked to it, directly or through others) and its number of links (other
documents with a similarity of the threshold or more, copies included).

Defined results: NULL, empty and wordless texts have no set: each is a class of its
own with no links; a NULL id sorts last as a class id; rows that repeat id and text are
separate rows and copies of each other; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from math import ceil, comb, log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.components import components
from newsflow.llm.store import stored, worker_cache
from newsflow.llm.word_ids import slices, strings

WORDS = 5
THRESHOLD = 0.8
DEPTH = 4
SMALL = 32
RECALL = 0.9999
#: A block of a component has about so many tokens and members at most; a tile is two blocks.
TILE_TOKENS = 150_000
TILE_MEMBERS = 2_000
#: Pairs of a tile that are judged at once.
STRIP_PAIRS = 1 << 20


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs after which a pair at ``threshold`` has shared a bucket with probability ``recall``."""
    return ceil(log(1 - recall) / log(1 - threshold ** depth))


def least_equal(runs: int, recall: float = RECALL, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    """The most equal samples to ask for, so that a pair at ``threshold`` is lost by that or by its paths with
    probability ``1 - recall`` at most (0 if the paths alone lose more)."""
    n = runs * depth
    lost = (1 - threshold ** depth) ** runs
    for k in range(n + 1):
        lost += comb(n, k) * threshold ** k * (1 - threshold) ** (n - k)
        if lost > 1 - recall:
            return k
    return n


class Shingles:
    """Sets of hashed word runs; ``cap`` bounds the memo of word hashes."""

    def __init__(self, words: int = WORDS, cap: int = 150_000):
        self.words, self.memo, self.cap = words, {}, cap

    def sets(self, texts):
        """``(tokens, offsets)``: text *i* has the sorted distinct 64-bit tokens ``tokens[offsets[i]:offsets[i + 1]]``."""
        import numpy as np
        import pyarrow.compute as pc
        from xxhash import xxh64_intdigest
        lists = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pN]+", " "), " ")
        coded = lists.flatten().dictionary_encode()
        if len(self.memo) > self.cap:
            self.memo.clear()
        memo, table = self.memo, []
        for w in coded.dictionary.to_pylist():
            h = memo.get(w)
            if h is None:
                h = memo[w] = xxh64_intdigest(w) | 1 if w else 0
            table.append(h)
        hashes = np.array(table, dtype=np.uint64)[coded.indices.to_numpy()] if table else np.zeros(0, np.uint64)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        text = np.repeat(np.arange(len(texts)), np.diff(offsets))
        text, hashes = text[hashes != 0], hashes[hashes != 0]
        count = np.bincount(text, minlength=len(texts))
        first = np.cumsum(count) - count
        size = np.where(count == 0, 0, np.maximum(count - self.words + 1, 1))
        owner = np.repeat(np.arange(len(texts)), size)
        start = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        mixed = np.zeros(len(owner), dtype=np.uint64)
        padded = np.append(hashes, np.zeros(self.words, np.uint64))
        for k in range(self.words):
            there = np.minimum(count[owner], self.words) > k
            mixed = (mixed ^ np.where(there, padded[start + k], np.uint64(0))) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        order = np.lexsort((mixed, owner))
        owner, mixed = owner[order], mixed[order]
        new = np.ones(len(owner), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (mixed[1:] != mixed[:-1])
        owner, mixed = owner[new], mixed[new]
        return mixed, np.searchsorted(owner, np.arange(len(texts) + 1))


def samples(tokens, offsets, n: int):
    """``n`` sampled tokens (32-bit min-hashes) per non-empty set, as an array of ``sets x n``."""
    import numpy as np
    rng = np.random.default_rng(20240611)
    odd = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    starts = offsets[:-1][offsets[1:] > offsets[:-1]]
    out = np.zeros((len(starts), n), dtype=np.int32)
    if len(starts):
        for i in range(n):
            mixed = (tokens ^ add[i]) * odd[i]
            mixed ^= mixed >> np.uint64(32)
            out[:, i] = (np.minimum.reduceat(mixed * odd[i], starts) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def signed_documents(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``(id, row, cls, size, sig)`` per row; ``cls`` digests the set (NULL: no set), ``row`` hashes id and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("row"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def sign(batches):
        from hashlib import blake2b

        import numpy as np
        import pyarrow as pa
        shingles = worker_cache("shingles", Shingles)
        for batch in batches:
            texts = strings(batch.column(2))
            for a, b in slices(texts):
                tokens, offsets = shingles.sets(texts.slice(a, b - a))
                size = np.diff(offsets)
                sig = np.zeros((b - a, n), dtype=np.int32)
                sig[size > 0] = samples(tokens, offsets, n)
                raw, at = memoryview(tokens).cast("B"), (offsets * 8).tolist()
                cls = [blake2b(raw[at[i]:at[i + 1]], digest_size=16).digest() if at[i + 1] > at[i] else None
                       for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(cls, pa.binary()),
                     pa.array(size, pa.int32()),
                     pa.ListArray.from_arrays(np.arange(0, (b - a + 1) * n, n, dtype=np.int32), sig.ravel())],
                    names=["id", "row", "cls", "size", "sig"])

    return rows.mapInArrow(sign, f"id {kind}, row long, cls binary, size int, sig array<int>")


def candidate_links(classes: DataFrame, runs: int, depth: int = DEPTH, small: int = SMALL,
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Candidate links ``(a, b)`` between classes ``(cls, sig)`` that shared a bucket in some run."""
    def path(r, d):
        return F.xxhash64(r, F.slice("sig", r * depth + 1, F.lit(d)))

    paths = classes.select("cls", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)),
        lambda r: F.struct(*[path(r, d).alias(f"p{d}") for d in range(1, depth + 1)]))).alias("p")).select("cls", "p.*")
    found = []
    for d in range(1, depth + 1):
        at = f"p{d}"
        # Written first, so that the join can be split at a path that very many sets share.
        shared = stored(paths.groupBy(at).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), f"shared_{d}")
        paths = stored(paths.join(shared, at).drop(*[f"p{k}" for k in range(1, d)]), f"paths_{d}")
        found.append(paths.filter(F.col("n") <= small).select(F.col(at).alias("leaf"), "cls"))
        paths = paths.filter(F.col("n") > small).drop("n")
    leaves = found[0]
    for f in found[1:]:
        leaves = leaves.unionByName(f)
    # The same members meet in many runs: each distinct bucket is compared once.
    lists = leaves.groupBy("leaf").agg(F.array_sort(F.collect_set("cls")).alias("members")).filter(
        F.size("members") > 1).select("members").distinct()
    members = lists.select(F.xxhash64("members").alias("leaf"), F.explode("members").alias("cls"))
    buckets = members.join(classes.select("cls", "sig"), "cls").groupBy("leaf").agg(
        F.collect_list(F.struct("cls", "sig")).alias("members"))
    floor = least_equal(runs, recall, threshold, depth)

    def compare(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            column = batch.column(0)
            bounds = column.offsets.to_numpy()
            structs = column.values
            names = structs.field("cls").to_pylist()
            sigs = structs.field("sig")
            n = len(sigs.values) // max(1, len(sigs))
            table = sigs.values.to_numpy().reshape(-1, n) if n else np.zeros((0, 0), np.int32)
            a, b = [], []
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                part = table[low:high]
                alike = (part[:, None, :] == part[None, :, :]).sum(axis=2) >= floor
                for i, parent in enumerate(spanning(alike)):
                    if parent != i:
                        a.append(names[low + i])
                        b.append(names[low + parent])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    compared = buckets.select("members").mapInArrow(compare, "a binary, b binary")
    deep = paths.select(F.col(f"p{depth}").alias("leaf"), "cls")
    star = deep.join(stored(deep.groupBy("leaf").agg(F.min("cls").alias("a")), "deep"), "leaf").select("a", F.col("cls").alias("b"))
    return compared.unionByName(star).filter("a <> b").distinct()


def spanning(linked):
    """Per node of a symmetric boolean matrix the first node of its connected group."""
    import numpy as np
    n = len(linked)
    root = np.full(n, -1)
    for i in range(n):
        if root[i] >= 0:
            continue
        front = np.zeros(n, dtype=bool)
        front[i] = True
        while front.any():
            root[front] = i
            front = linked[front].any(axis=0) & (root < 0)
    return root.tolist()


def tiled(members: DataFrame) -> DataFrame:
    """``(pack, i, j, root, block, cls, copies, tokens)``: every two blocks of a root meet in tile ``i <= j`` of its pack."""
    totals = members.groupBy("root").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n"))
    blocks = totals.withColumn("blocks", F.greatest(
        F.ceil(F.col("total") / TILE_TOKENS), F.ceil(F.col("n") / TILE_MEMBERS)).cast("int")).drop("n")
    small = blocks.filter("blocks = 1").agg(F.sum("total")).first()[0] or 0
    packs = max(1, -(-int(small) // (2 * TILE_TOKENS)))
    placed = members.join(blocks.drop("total"), "root").withColumn(
        "block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    # Components of one block share tasks; a larger one is its own set of tiles.
    placed = placed.withColumn("pack", F.when(F.col("blocks") == 1, F.lpad(
        F.pmod(F.xxhash64("root"), F.lit(packs)).cast("string"), 12, "0").cast("binary")).otherwise(F.col("root")))
    return placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "pack", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "root", "block", "cls",
        "copies", "tokens")


def verified(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(cls, other, links)`` of exact links between ``members(root, cls, copies, size, tokens)`` of one root."""
    strip_pairs = STRIP_PAIRS

    def compare(table):
        import numpy as np
        import pyarrow as pa
        table = table.sort_by([("root", "ascending"), ("block", "ascending")]).combine_chunks()
        roots = table.column("root").to_pylist()
        names = table.column("cls").to_pylist()
        block = table.column("block").to_numpy()
        copies = table.column("copies").to_numpy()
        lists = table.column("tokens").combine_chunks()
        offsets, tokens = lists.offsets.to_numpy(), lists.values.to_numpy()
        across = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        out = [], [], []
        low = 0
        while low < len(roots):
            high = low
            while high < len(roots) and roots[high] == roots[low]:
                high += 1
            n = high - low
            own = tokens[offsets[low]:offsets[high]]
            size = np.diff(offsets[low:high + 1])
            owner = np.repeat(np.arange(n), size)
            _, code, df = np.unique(own, return_inverse=True, return_counts=True)
            keep = df[code] > 1
            owner, code = owner[keep], np.unique(code[keep], return_inverse=True)[1]
            both = np.zeros((n, n), dtype=np.float32)
            width = max(1, (1 << 21) // n)
            order = np.argsort(code, kind="stable")
            owner, code = owner[order], code[order]
            for at in range(0, int(code[-1]) + 1 if len(code) else 0, width):
                a, b = np.searchsorted(code, [at, at + width])
                has = np.zeros((n, width), dtype=np.float32)
                has[owner[a:b], code[a:b] - at] = 1.0
                both += has @ has.T
            side = block[low:high]
            linked, links = np.zeros((n, n), dtype=bool), np.zeros(n, dtype=np.int64)
            rows = max(1, strip_pairs // n)
            for a in range(0, n, rows):
                b = min(n, a + rows)
                part = both[a:b] >= threshold * (size[a:b, None] + size[None, :] - both[a:b]) - 1e-6
                part[np.arange(b - a), np.arange(a, b)] = False
                if across:  # a tile of two blocks, one of which may be empty: only the pairs across
                    part &= side[a:b, None] != side[None, :]
                linked[a:b], links[a:b] = part, part @ copies[low:high]
            for i, parent in enumerate(spanning(linked)):
                if links[i]:
                    out[0].append(names[low + i])
                    out[1].append(names[low + parent])
                    out[2].append(int(links[i]))
            low = high
        return pa.table({"cls": pa.array(out[0], pa.binary()), "other": pa.array(out[1], pa.binary()),
                         "links": pa.array(out[2], pa.int64())})

    return tiled(members).groupBy("pack", "i", "j").applyInArrow(compare, "cls binary, other binary, links long")


def linked_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``(id, row, class_id, n_links, kept)`` for every row of ``docs``."""
    runs = runs_for(recall, threshold)
    signed = stored(signed_documents(docs, id_col, text_col, runs * DEPTH), "ngram_signed")
    classes = signed.filter("cls is not null").groupBy("cls").agg(
        F.min("id").alias("first"), F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"),
        F.max("size").alias("size"), F.min("sig").alias("sig"))
    classes = stored(classes, "ngram_classes")
    roots = components(candidate_links(classes, runs, threshold=threshold, recall=recall), "ngram_candidates")

    # The sets of the candidates, made again from one document of each class.
    wanted = roots.withColumnRenamed("node", "cls").join(classes.select("cls", "row", "copies"), "cls")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(F.col(id_col), text).alias("row"), text.alias("text"))

    def sets(batches):
        import pyarrow as pa
        shingles = worker_cache("shingles", Shingles)
        for batch in batches:
            texts = strings(batch.column(3))
            for a, b in slices(texts):
                tokens, offsets = shingles.sets(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(a, b - a) for k in range(3)],
                     pa.array(offsets[1:] - offsets[:-1], pa.int32()),
                     pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(tokens.view("int64")))
                     .cast(pa.list_(pa.int64()))], names=["root", "cls", "copies", "size", "tokens"])

    members = texts.join(wanted, "row").select("root", "cls", "copies", "text").mapInArrow(
        sets, "root binary, cls binary, copies long, size int, tokens array<bigint>")
    # Rows that repeat id and text gave one set more than once.
    members = members.groupBy("root", "cls").agg(F.first("copies").alias("copies"), F.first("size").alias("size"),
                                                 F.first("tokens").alias("tokens"))
    links = stored(verified(stored(members, "ngram_members"), threshold), "ngram_links")
    groups = components(links.select(F.col("cls").alias("a"), F.col("other").alias("b")), "ngram_groups")

    counted = links.groupBy("cls").agg(F.sum("links").alias("links"))
    named = classes.select("cls", "first", "copies").join(groups.withColumnRenamed("node", "cls"), "cls", "left").join(
        counted, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    firsts = named.groupBy("root").agg(F.min("first").alias("class_id"))
    named = named.join(firsts, "root").select(
        "cls", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = signed.select("id", "row", "cls").join(named, "cls", "left")
    class_id = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("class_id"))
    return out.select("id", "row", class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      F.coalesce(F.col("cls"), F.lit(b"")).alias("cls"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``(id, class_id, n_links)`` for every row of ``docs``."""
    return linked_documents(docs, id_col, text_col, threshold).select(F.col("id").alias(id_col), "class_id", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay, one per class (its smallest id), with all their columns."""
    found = linked_documents(docs, id_col, text_col, threshold)
    # A class without words, and one whose ids are all NULL, is kept by its row.
    gone = found.filter(F.length("cls") > 0).filter(~F.col("id").eqNullSafe(F.col("class_id"))).select(
        F.col("row").alias("__row")).distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumn("__row", F.xxhash64(F.col(id_col), text))
    return keyed.join(gone, "__row", "left_anti").drop("__row")
