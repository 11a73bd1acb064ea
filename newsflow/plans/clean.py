"""JOB-1 clean, PRJ-10 label, PRJ-9 text, JOB-2 preprocess.

One ``select`` per step keeps the projections collapsed; ``dropna`` sits below
the dedup aggregate, and the NULL keys never reach the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import build_text, clean_list, parse_compact_ts, tone_label, tone_score, url_host
from newsflow.operators.dedup import first_per_key, first_per_key_window
from newsflow.schemas import GKG_COLUMNS, LIST_COLUMNS, TEXT_COLUMNS

GKG_NAMES = list(GKG_COLUMNS.values())


def parse_fields(df: DataFrame) -> DataFrame:
    """PRJ-1, PRJ-4, PRJ-5 x5, PRJ-8, PRJ-17: typed, cleaned columns; ``raw_date``/``tone_raw`` dropped.

    ``source`` becomes the URL host, as in the reference's batch path; the outlet
    name of the raw line stays as ``outlet``.
    """
    replaced = {
        "event_time": parse_compact_ts("raw_date"),
        "tone_score": tone_score("tone_raw"),
        "outlet": F.col("source"),
        "source": url_host("url"),
        **{c: clean_list(c) for c in LIST_COLUMNS if c in df.columns},
    }
    return df.withColumns(replaced).drop("raw_date", "tone_raw")


def add_tone_label(df: DataFrame, score_col: str = "tone_score") -> DataFrame:
    """PRJ-10: ``sentiment_label`` from the tone score."""
    return df.withColumn("sentiment_label", tone_label(score_col))


def add_text(df: DataFrame, cols=TEXT_COLUMNS, out: str = "text") -> DataFrame:
    """PRJ-9: document text for the tokenizer."""
    return df.withColumn(out, build_text(*cols))


def clean(df: DataFrame, dedup: str = "aggregate", label: bool = True) -> DataFrame:
    """JOB-1: parse, drop rows without URL or time, one row per URL (earliest time, then id).

    Only ``event_time`` is needed to filter and to pick the survivor; the other
    field transforms are row-wise and do not touch the key or the order, so they
    run after the dedup, on the surviving rows only (the list regexes over whole
    texts are the expensive part). Same result as parsing everything first.
    """
    timed = df.withColumn("event_time", parse_compact_ts("raw_date")).dropna(subset=["url", "event_time"])
    first = first_per_key if dedup == "aggregate" else first_per_key_window
    survivors = first(timed, ["url"], ["event_time", "record_id"])
    out = parse_fields(survivors.drop("event_time"))
    return add_tone_label(out) if label else out


def preprocess(df: DataFrame) -> DataFrame:
    """JOB-2 without the model: ``record_id, url, event_time, tone_score, sentiment_label, source, text``.

    ``newsflow.operators.model.featurize`` adds the TF-IDF vector with a fitted model.
    """
    out = add_text(clean(df))
    return out.select("record_id", "url", "event_time", "tone_score", "sentiment_label",
                      "source", "text")


def preprocess_batch(spark, path: str, model=None, store=None) -> DataFrame:
    """JOB-2 on a GKG file: scan -> clean -> label -> text -> (fit and save if no model) -> features.

    ``model``: a fitted ``PipelineModel`` to reuse; otherwise ``store`` (a
    ``ModelStore``) loads the current version or trains and saves a new one; by
    default the store of the shared folder.
    """
    from newsflow.operators.model import ModelStore, featurize
    from newsflow.session import shared_path
    from newsflow.sources.gkg import read_gkg
    prepared = preprocess(read_gkg(spark, path))
    if model is None:
        store = store if store is not None else ModelStore(spark, shared_path(spark, "models", unique=False))
        model = store.load_or_train(prepared)
    return featurize(model, prepared) if model is not None else prepared
