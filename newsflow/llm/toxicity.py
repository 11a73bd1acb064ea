"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text (lower case, letters and digits), each counted once, hashed
into ``2 ** BITS`` coordinates: words, word beginnings of 4 to 6 characters (stems
that inflected forms share), word pairs, and pairs with one word between them.

Learning: a bounded sample of labelled rows (at most ``SAMPLE`` rows, those with the
smallest hashes of their ids), dealt by hash to shards of about ``SHARD_ROWS``. Each shard runs
FTRL-proximal (a learning rate per coordinate, L1 for sparsity) over its rows in
hash order; the shards' states are averaged per coordinate in Spark. L1 leaves few
weights: only those come to the driver (at most ``2 ** BITS``, whatever the input)
and go out with the scoring function. A last logistic fit of two numbers on the
sample's sums (Platt scaling; at most ``SAMPLE`` pairs) sets their scale and offset. Rows whose ``crc32(id as text) % 5`` is 0 are
never learned from; language, source and id are never features.

Scoring is one map over all texts.

Defined results: NULL and empty texts get the score of the intercept alone; a
NULL id is not held out (and not learned from); labels that repeat an id count
as their maximum, documents that repeat an id are learned once (the smallest
text); without labelled rows every score is 0.5 and nothing is predicted toxic;
empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from newsflow.llm.store import stored, worker_cache
from newsflow.llm.word_ids import slices, strings

BITS = 20
SAMPLE = 20_000
SHARD_ROWS = 2_500
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 2.0, 0.1
FOLDS = 5
#: Texts whose features are in memory at once (about 30 times as many bytes).
SLICE_BYTES = 1 << 21


def held_out(id_col: str) -> Column:
    """``crc32(id as text) % 5 = 0``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class Features:
    """Hashed features of texts."""

    @staticmethod
    def _hashes(word: str):
        from zlib import crc32
        raw = word.encode("utf-8")
        size = len(word)
        return (crc32(raw), *[crc32((word[:n] + "*").encode("utf-8")) if size >= n else 0 for n in (4, 5, 6)])

    def pairs(self, texts, wanted=None):
        """``(text number, coordinate)``, each once and in order; only coordinates that ``wanted`` marks, if given.

        Coordinate 0 is kept for the intercept and never given.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        lists = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pN]+", " "), " ")
        coded = lists.flatten().dictionary_encode()
        hashes = np.array([self._hashes(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64).reshape(-1, 4)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        text = np.repeat(np.arange(len(texts)), np.diff(offsets))
        codes = coded.indices.to_numpy()
        real = hashes[codes, 0] != 0 if len(codes) else np.zeros(0, bool)  # the empty word's crc32 is 0
        codes, text = codes[real], text[real]
        word = hashes[codes, 0] if len(codes) else np.zeros(0, np.uint64)
        first, second, mask = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64((1 << BITS) - 1)
        out = []

        def add(which, mixed):
            at = (mixed >> np.uint64(40)) & mask
            keep = at != 0 if wanted is None else wanted[at]
            out.append((which[keep].astype(np.int64) << BITS) | at[keep].astype(np.int64))

        if len(codes):
            for k in range(4):
                h = hashes[:, k] * first
                column, there = h[codes], hashes[codes, k] != 0
                add(text[there], column[there])
            for gap in (1, 2):
                same = text[gap:] == text[:-gap]
                mixed = (word[:-gap] * first + np.uint64(gap)) ^ (word[gap:] * second)
                add(text[gap:][same], mixed[same] * first)
        both = np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)
        return both >> BITS, both & ((1 << BITS) - 1)


def proximal(z, n, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
    """FTRL-proximal weights of the state ``(z, n)``; zero where L1 holds."""
    import numpy as np
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def train(examples, epochs: int = EPOCHS):
    """State ``(z, n)`` after FTRL over ``examples``: a list of ``(coordinates, label)``."""
    import numpy as np
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(epochs):
        for at, label in examples:
            zi, ni = z[at], n[at]
            w = proximal(zi, ni)
            w[0] = -zi[0] / ((BETA + np.sqrt(ni[0])) / ALPHA)  # the intercept is not shrunk
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35.0, 35.0))) - label
            root = np.sqrt(ni + g * g)
            z[at] = zi + g - (root - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
    return z, n


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", sample: int = SAMPLE) -> dict[int, float]:
    """Non-zero weights by coordinate (0: intercept)."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
             .filter(F.col("id").isNotNull() & F.col("label").isNotNull()))
    known = known.filter(~held_out("id")).groupBy("id").agg(F.max("label").alias("label"))
    # At most ``sample`` rows of two numbers: a proven bound for the broadcast.
    chosen = stored(known.orderBy(F.xxhash64("id"), "id").limit(sample), "toxicity_labels")
    shards = max(1, -(-chosen.count() // SHARD_ROWS))
    chosen = F.broadcast(chosen)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = stored(texts.join(chosen, "id").groupBy("id", "label").agg(F.min("text").alias("text")).select(
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"), "id", "label", "text"),
        "toxicity_sample")

    def learn(table):
        import numpy as np
        import pyarrow as pa
        table = table.sort_by([("id", "ascending")])
        order = np.random.default_rng(7).permutation(len(table))
        table = table.take(pa.array(order))
        texts, made = table.column("text").combine_chunks(), []
        feats = worker_cache("toxicity features", Features)
        for a, b in slices(texts, SLICE_BYTES):
            which, at = feats.pairs(texts.slice(a, b - a))
            bounds = np.searchsorted(which, np.arange(b - a + 1))
            made += [np.append(0, at[bounds[i]:bounds[i + 1]]).astype(np.int32) for i in range(b - a)]
        z, n = train(list(zip(made, table.column("label").to_pylist())))
        seen = np.flatnonzero(n)
        return pa.table({"at": pa.array(seen, pa.int32()), "z": pa.array(z[seen]), "n": pa.array(n[seen])})

    states = rows.groupBy("shard").applyInArrow(learn, "at int, z double, n double")
    merged = states.groupBy("at").agg((F.sum("z") / shards).alias("z"), (F.sum("n") / shards).alias("n"))
    rate = (F.lit(BETA) + F.sqrt("n")) / ALPHA
    weight = F.when(F.col("at") == 0, -F.col("z") / rate).when(
        F.abs("z") > L1, -(F.col("z") - F.signum("z") * L1) / (rate + L2)).otherwise(F.lit(0.0))
    found = merged.select("at", weight.alias("w")).filter("w <> 0").toPandas()  # at most 2 ** BITS rows
    weights = dict(zip(found["at"].tolist(), found["w"].tolist()))
    if not weights:
        return {}
    sums = rows.select(_sums(weights)("text").alias("sum"), "label").toPandas()  # at most ``sample`` rows
    slope, offset = platt(sums["sum"].to_numpy(), sums["label"].to_numpy())
    return {at: slope * w + (offset if at == 0 else 0.0) for at, w in {0: 0.0, **weights}.items()}


def platt(sums, labels, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic fit of ``labels`` on ``sums`` (Newton steps, lightly damped)."""
    import numpy as np
    theta, x = np.array([1.0, 0.0]), np.stack([sums, np.ones(len(sums))], axis=1)
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ theta, -35.0, 35.0)))
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.linalg.solve(curve, x.T @ (p - labels) + 1e-3 * (theta - [1.0, 0.0]))
    return float(theta[0]), float(theta[1])


def _sums(weights: dict[int, float]):
    """A column function: the sum of a text's weights, with the intercept."""
    import numpy as np
    at = np.array(sorted(weights), dtype=np.int64)
    values = np.array([weights[i] for i in at.tolist()], dtype=np.float64)

    @F.arrow_udf("double")
    def sums(column):
        import numpy as np
        import pyarrow as pa
        full = np.zeros(1 << BITS)
        full[at] = values
        wanted = full != 0
        wanted[0] = False
        feats = worker_cache("toxicity features", Features)
        texts, out = strings(column), np.full(len(column), full[0])
        for a, b in slices(texts, SLICE_BYTES):
            which, coordinate = feats.pairs(texts.slice(a, b - a), wanted)
            out[a:b] += np.bincount(which, weights=full[coordinate], minlength=b - a)
        return pa.array(out)

    return sums


def score(docs: DataFrame, weights: dict[int, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on); columns of these names are replaced."""
    scored = docs.withColumn("score", 1.0 / (1.0 + F.exp(-_sums(weights)(F.col(text_col)))))
    return scored.withColumn("predicted", (F.lit(bool(weights)) & (F.col("score") >= 0.5)).cast("int"))
