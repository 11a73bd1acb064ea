"""Text features (ML-1 .. ML-5): Spark ML stages and their column/SQL twins.

The ML stages (``RegexTokenizer``, ``StopWordsRemover``, ``HashingTF``, ``IDF``)
are what the reference runs. The twins compute the same tokens, filtered tokens,
document frequencies and TF-IDF weights per *term* with built-in column
functions and aggregates, so they can be checked against SQL and run without
the 10,000-bucket hash (which no SQL engine reproduces).

Scale notes
  * tokens stay inside the row (``split`` + ``filter``); no Python.
  * term counts: inside the row (sorted tokens, run lengths), no shuffle.
  * document frequency: ``groupBy(term)`` over the per-document pairs, again with a
    partial aggregate, so a term present in every document costs one row per map task.
  * TF-IDF joins the pairs with the vocabulary on ``term``. AQE broadcasts the
    vocabulary by its measured bytes; else it shuffles and splits hot terms.
"""

from __future__ import annotations

import functools
import os
import zipfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.schemas import MIN_DOC_FREQ, MIN_TOKEN_LENGTH, NUM_FEATURES, TOKEN_PATTERN


def _ml_jar() -> str | None:
    """Path of the installed Spark ML jar: ``SPARK_HOME/jars``, or a ``jars`` folder beside or above the
    ``pyspark`` package (which may itself sit inside ``pyspark.zip``); None when there is none."""
    import pyspark
    here = os.path.dirname(os.path.abspath(pyspark.__file__))
    roots = [os.environ["SPARK_HOME"]] if os.environ.get("SPARK_HOME") else []
    while here != os.path.dirname(here):
        roots.append(here)
        here = os.path.dirname(here)
    for root in roots:
        jars = os.path.join(root, "jars")
        if os.path.isdir(jars):
            for name in sorted(os.listdir(jars)):
                if name.startswith("spark-mllib_") and name.endswith(".jar"):
                    return os.path.join(jars, name)
    return None


@functools.lru_cache(maxsize=4)
def default_stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark ML's default stop-word list (``StopWordsRemover.loadDefaultStopWords``).

    Taken from the running session's JVM when there is one; otherwise (SQL twins
    built without Spark) from the installed Spark ML jar.
    """
    from pyspark import SparkContext
    if SparkContext._active_spark_context is not None:
        from pyspark.ml.feature import StopWordsRemover
        return tuple(StopWordsRemover.loadDefaultStopWords(language))
    jar = _ml_jar()
    if jar is None:
        raise FileNotFoundError("no running session and no Spark ML jar: the stop-word list is unknown")
    with zipfile.ZipFile(jar) as z:
        raw = z.read(f"org/apache/spark/ml/feature/stopwords/{language}.txt")
    return tuple(w for w in raw.decode("utf-8").split("\n") if w)


def tokenize(text, pattern: str = TOKEN_PATTERN, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """ML-1 twin: lowercase, split on ``pattern`` (Java regex), keep tokens of ``min_length`` or more."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.lower(text), pattern)
    return F.filter(parts, lambda t: F.length(t) >= min_length)


def remove_stop_words(tokens, stop_words=None) -> Column:
    """ML-2 twin: drop stop words, case-insensitive (an ``InSet`` hash lookup per token)."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    words = list(stop_words if stop_words is not None else default_stop_words())
    return F.filter(tokens, lambda t: ~F.lower(t).isin(words))


def term_counts(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """``(id, term, tf)``: occurrences of each term per document, counted inside the row.

    All tokens of a document are in its row, so no shuffle is needed: the token
    array is sorted and each run of equal terms becomes one ``(term, tf)`` pair
    (run ends are the positions where the next term differs). The sorted array
    and the run ends are projected as columns first, so each lambda reads them
    instead of re-sorting. Equal to ``explode`` + ``groupBy(id, term).count()``,
    without that pipeline's largest shuffle.
    """
    sorted_ = df.select(id_col, F.array_sort(F.col(tokens_col)).alias("__s"))
    s, n = F.col("__s"), F.size("__s")
    ends = F.when(n > 0, F.filter(F.sequence(F.lit(1), n),
                                  lambda i: (i == n) | (F.element_at(s, i) != F.element_at(s, i + 1))))
    with_ends = sorted_.select(id_col, "__s", F.coalesce(ends, F.array().cast("array<int>")).alias("__e"))
    e = F.col("__e")
    pairs = F.transform(e, lambda end, k: F.struct(
        F.element_at(s, end).alias("term"),
        (end - F.when(k == 0, F.lit(0)).otherwise(F.element_at(e, k))).cast("long").alias("tf")))
    return with_ends.select(id_col, F.inline(pairs))


def document_frequency(pairs: DataFrame, id_col: str) -> DataFrame:
    """AGG-4 twin: ``(term, df)`` documents per term, from per-document ``(id, term)`` pairs."""
    return pairs.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf_weight(df_col, n_docs_col, min_doc_freq: int = MIN_DOC_FREQ) -> Column:
    """ML-4 weight ``ln((m + 1) / (df + 1))``; zero below ``min_doc_freq`` (as Spark's IDF)."""
    dfc = F.col(df_col) if isinstance(df_col, str) else df_col
    m = F.col(n_docs_col) if isinstance(n_docs_col, str) else n_docs_col
    return F.when(dfc >= min_doc_freq, F.log((m + 1.0) / (dfc + 1.0))).otherwise(F.lit(0.0))


def tfidf(docs: DataFrame, id_col: str, tokens_col: str,
          min_doc_freq: int = MIN_DOC_FREQ, materialize_counts: bool = True) -> DataFrame:
    """ML-4 twin on unhashed terms: ``(id, term, tf, df, idf, tfidf)``.

    The per-document counts feed both the frequencies and the join, so they are
    written once to the shared folder (``materialize_counts``) instead of
    tokenizing twice. The weight is computed on the vocabulary (one row per
    term), which joins the counts on ``term``: AQE broadcasts it by its measured
    bytes, or shuffles and splits hot terms. ``m`` counts every document, also
    those without a term, as ``IDF.fit`` does; it is a one-row aggregate.
    """
    from newsflow.operators.joins import materialize
    tf = term_counts(docs, id_col, tokens_col)
    if materialize_counts:
        tf = materialize(tf, "term_counts")
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    vocabulary = document_frequency(tf, id_col).crossJoin(F.broadcast(n_docs)).select(
        "term", "df", idf_weight("df", "n_docs", min_doc_freq).alias("idf"))
    return tf.join(vocabulary, "term").select(id_col, "term", "tf", "df", "idf",
                                              (F.col("tf") * F.col("idf")).alias("tfidf"))


def build_ml_pipeline(input_col: str = "text", num_features: int = NUM_FEATURES,
                      min_doc_freq: int = MIN_DOC_FREQ, locale: str = "en_US"):
    """ML-5: ``RegexTokenizer -> StopWordsRemover -> HashingTF -> IDF`` (unfitted).

    Output columns: ``tokens``, ``filtered_tokens``, ``raw_features``, ``features``.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StopWordsRemover
    tokenizer = RegexTokenizer(inputCol=input_col, outputCol="tokens", pattern=TOKEN_PATTERN,
                               minTokenLength=MIN_TOKEN_LENGTH)
    remover = StopWordsRemover(inputCol="tokens", outputCol="filtered_tokens", locale=locale)
    hashing = HashingTF(inputCol="filtered_tokens", outputCol="raw_features", numFeatures=num_features)
    idf = IDF(inputCol="raw_features", outputCol="features", minDocFreq=min_doc_freq)
    return Pipeline(stages=[tokenizer, remover, hashing, idf])


def hashed_term_frequencies(df: DataFrame, text_col: str = "text",
                            num_features: int = NUM_FEATURES) -> DataFrame:
    """ML-3: the fitted-free part of the pipeline (tokenize, stop words, hash) as a transform."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import HashingTF, RegexTokenizer, StopWordsRemover
    stages = [
        RegexTokenizer(inputCol=text_col, outputCol="tokens", pattern=TOKEN_PATTERN,
                       minTokenLength=MIN_TOKEN_LENGTH),
        StopWordsRemover(inputCol="tokens", outputCol="filtered_tokens", locale="en_US"),
        HashingTF(inputCol="filtered_tokens", outputCol="raw_features", numFeatures=num_features),
    ]
    return PipelineModel(stages).transform(df)
