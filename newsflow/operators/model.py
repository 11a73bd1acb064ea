"""Model lifecycle (ML-5 .. ML-9, STR-6): fit, save, load, load-or-train, score.

Models are written to versioned directories under one root, and a small
``CURRENT`` pointer file names the live version. The pointer is written only
after the save finished, a failed load never deletes anything (a new version is
trained instead), and the flag file of the reference has no place to be lost.
All file access goes through the Hadoop file system of the root (HDFS, S3, local).
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

from newsflow.files import hadoop_path, put_file, read_file
from newsflow.operators.text import build_ml_pipeline

log = logging.getLogger(__name__)
POINTER = "CURRENT"
#: What an error about a missing or broken version says.
UNREADABLE = ("PATH_NOT_FOUND", "does not exist", "InvalidInputException", "FileNotFoundException", "empty collection",
              "MappingException", "JsonParseException", "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER")


class ModelStore:
    """Versioned ``PipelineModel`` store; the loaded model is cached in the instance."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._model = self._version = None

    def _fs(self, path: str):
        return hadoop_path(self.spark, path)

    def current_version(self) -> str | None:
        return self._read(POINTER)

    def _read(self, name: str) -> str | None:
        text = read_file(self.spark, f"{self.root}/{name}")
        return text.strip() if text else None

    def _put(self, name: str, version: str, replace: bool = True) -> bool:
        """Put a file that names ``version`` in place; ``replace=False``: only where there is none yet."""
        return put_file(self.spark, f"{self.root}/{name}", version, replace)

    def save(self, model) -> str:
        """ML-6: write ``model`` as a new version, then switch the pointer to it."""
        version = self._write(model)
        self._put(POINTER, version)
        self._model, self._version = model, version
        return version

    def _write(self, model) -> str:
        version = dt.datetime.now(dt.timezone.utc).strftime("v%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
        model.write().save(f"{self.root}/{version}")
        return version

    def succeed(self, model, seen: str | None):
        """Publish ``model`` as the one version that follows ``seen`` (None: the first one); returns the live model.

        Of several jobs that found the same state, the one that creates the claim on its successor wins. The
        others drop what they trained and load the winner's model; if the winner ended between its claim
        and the pointer, they move the pointer for it (the version was complete before it was claimed).
        """
        version, claim = self._write(model), f".after-{seen or 'nothing'}"
        if self._put(claim, version, replace=False):
            self._put(POINTER, version)
            self._model, self._version = model, version
            return model
        if self.current_version() == seen:
            self._put(POINTER, self._read(claim))
        p, fs = self._fs(f"{self.root}/{version}")
        fs.delete(p, True)
        return self.load()

    def load(self):
        """ML-7: the current model, or None when there is none."""
        from pyspark.ml import PipelineModel
        version = self.current_version()
        if version is None:
            return None
        if self._model is None or version != self._version:
            self._model, self._version = PipelineModel.load(f"{self.root}/{version}"), version
        return self._model

    def fit_and_save(self, training: DataFrame, pipeline=None):
        """ML-6: fit on ``training`` (which must hold at least one row) and save a new version."""
        model = (pipeline or build_ml_pipeline()).fit(training)
        self.save(model)
        return model

    def load_or_train(self, training: DataFrame, pipeline=None):
        """ML-8: the current version (read again when another job has published one), or train a new one.

        Only a version whose files are missing or cannot be parsed is replaced by a new one; other
        errors (a file system that is down for a moment) are raised. Returns None when there is no
        model and ``training`` is empty (IDF cannot be fitted on nothing). Jobs that train at
        the same time leave one version (``succeed``).
        """
        seen = self.current_version()
        try:
            if self.load() is not None:
                return self._model
        except Exception as exc:
            if not any(sign in str(exc) for sign in UNREADABLE):
                raise
            log.warning("model version is unreadable (%s); training a new one", exc)
        if training.isEmpty():
            return None
        return self.succeed((pipeline or build_ml_pipeline()).fit(training), seen)


def featurize(model, df: DataFrame) -> DataFrame:
    """ML-9: score a batch (``tokens``, ``filtered_tokens``, ``raw_features``, ``features``).

    Works on a streaming DataFrame as well: the stages are row-wise.
    """
    return model.transform(df)
