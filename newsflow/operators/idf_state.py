"""Document frequencies as a mergeable state: refit IDF without rereading the texts (AGG-4, ML-4).

A batch of documents leaves one row per batch: its number of documents and, per hashed term, how many of them
hold it (``Summarizer.numNonZeros``, an aggregation with partial sums). States of different batches add up, so a
model over all batches, or over any of them, needs only these rows: ``num_features`` numbers a batch.

A batch that is run again replaces its own row. The refitted model is an ordinary ``IDFModel``: its weights are
those of ``IDF.fit`` on the union of the batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.text import hashed_term_frequencies
from newsflow.schemas import MIN_DOC_FREQ, NUM_FEATURES
from newsflow.session import shared_path
from newsflow.sinks.parquet import path_exists

SCHEMA = "docs long, doc_freq array<long>, batch string"


class IdfState:
    """Counts per batch under ``path``."""

    def __init__(self, spark: SparkSession, path: str, num_features: int = NUM_FEATURES):
        self.spark, self.path, self.num_features = spark, path, num_features

    def add(self, docs: DataFrame, batch: Column, text_col: str = "text") -> None:
        """Count the documents of each batch that occurs; a batch's former counts are replaced."""
        from pyspark.ml.functions import vector_to_array
        from pyspark.ml.stat import Summarizer
        texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), batch.cast("string").alias("batch")).filter(
            "batch IS NOT NULL")
        hashed = hashed_term_frequencies(texts, "text", self.num_features)
        counts = hashed.groupBy("batch").agg(F.count(F.lit(1)).alias("docs"),
                                             Summarizer.numNonZeros(F.col("raw_features")).alias("v"))
        (counts.select("docs", vector_to_array("v").cast("array<long>").alias("doc_freq"), "batch")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.path))

    def states(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def merged(self, states: DataFrame | None = None) -> tuple[int, list[int]]:
        """``(documents, document frequency per hashed term)`` of all states, or of those given."""
        states = self.states() if states is None else states
        n = states.agg(F.sum("docs")).first()[0] or 0
        freq = [0] * self.num_features
        for r in states.select(F.posexplode("doc_freq")).groupBy("pos").agg(F.sum("col").alias("f")).collect():
            freq[r.pos] = r.f
        return n, freq

    def model(self, states: DataFrame | None = None, min_doc_freq: int = MIN_DOC_FREQ):
        """The ``IDFModel`` of the merged states (None where they hold no document)."""
        from pyspark.ml.feature import IDF, IDFModel
        from pyspark.ml.linalg import Vectors, VectorUDT
        from pyspark.sql.types import ArrayType, LongType, StructField, StructType
        n, freq = self.merged(states)
        if not n:
            return None
        weights = self.spark.createDataFrame(enumerate(freq), "pos int, f long").select("pos", F.when(
            F.col("f") >= min_doc_freq, F.log((F.lit(n) + 1.0) / (F.col("f") + 1.0))).otherwise(0.0).alias("w")).collect()
        # The model's own file format: metadata as any IDFModel writes it, data with our numbers.
        path = shared_path(self.spark, "idf_model")
        one = self.spark.createDataFrame([(Vectors.sparse(self.num_features, {}),)], ["raw_features"])
        IDF(inputCol="raw_features", outputCol="features", minDocFreq=min_doc_freq).fit(one).write().save(path)
        schema = StructType([StructField("idf", VectorUDT()), StructField("docFreq", ArrayType(LongType())),
                             StructField("numDocs", LongType())])
        idf = Vectors.dense([r.w for r in sorted(weights, key=lambda r: r.pos)])
        often = [f if f >= min_doc_freq else 0 for f in freq]  # a model counts no rarer terms
        self.spark.createDataFrame([(idf, often, n)], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
        return IDFModel.load(path)

    def refit(self, model, min_doc_freq: int = MIN_DOC_FREQ):
        """The fitted pipeline ``model`` with its last stage replaced by the merged states' weights."""
        from pyspark.ml import PipelineModel
        return PipelineModel([*model.stages[:-1], self.model(min_doc_freq=min_doc_freq)])
