"""Batch scoring with a pluggable predictor.

The model boundary is ``pyspark.ml.functions.predict_batch_udf``: Arrow batches
of ``batch_size`` rows go to a Python worker, the predictor is built once per
worker by ``make_predictor`` (not per row, not per batch), and results come
back as a string column. Everything before (prompt building) and after (label
extraction, metrics) stays in JVM expressions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from labelflow.functions.extract import extract_label
from labelflow.functions.text import WS, _c
from labelflow.session import scratch_dir

# A predictor maps a batch of input strings to a batch of raw output strings.
Predictor = Callable[[Sequence[str]], Sequence[str]]


def predictor_udf(make_predictor: Callable[[], Predictor], batch_size: int = 64):
    """A column function ``text -> raw_prediction`` running ``make_predictor()`` once per worker."""
    from pyspark.ml.functions import predict_batch_udf

    def make_predict_fn():
        model = make_predictor()

        def predict(inputs: np.ndarray) -> np.ndarray:
            texts = ["" if x is None else str(x) for x in inputs]
            return np.asarray(list(model(texts)), dtype=object)

        return predict

    return predict_batch_udf(make_predict_fn, return_type=StringType(), batch_size=batch_size)


def score(df: DataFrame, make_predictor: Callable[[], Predictor], text: str | Column,
          labels: Sequence[str] | None = None, strategy: str = "cascade", batch_size: int = 64,
          raw_col: str = "raw_prediction", pred_col: str = "predicted_label") -> DataFrame:
    """Run the predictor over ``text`` and extract a canonical label with ``strategy``."""
    raw = predictor_udf(make_predictor, batch_size)(_c(text))
    out = df.withColumn(raw_col, raw)
    return out.withColumn(pred_col, extract_label(F.col(raw_col), labels, strategy))


def prediction_records(df: DataFrame, utterance: str = "utterance", gold: str = "gold_label",
                       pred: str = "predicted_label", raw: str | None = "raw_prediction",
                       mode: str | None = None, model_name: str | None = None,
                       key: str | None = "example_id") -> DataFrame:
    """Project to the prediction record shape (P19); ``example_id`` kept as the row key."""
    cols = ([F.col(key)] if key else []) + [F.col(utterance).alias("utterance"), F.col(gold).alias("gold_label"),
                                           F.col(pred).alias("predicted_label")]
    if raw:
        cols.append(F.col(raw).alias("raw_prediction"))
    if mode is not None:
        cols.append(F.lit(mode).alias("mode"))
    if model_name is not None:
        cols.append(F.lit(model_name).alias("model_name"))
    return df.select(*cols)


def token_count(text, pattern: str | None = None) -> Column:
    """Number of whitespace tokens (M04), or of the parts between matches of ``pattern``; 0 for empty text."""
    if pattern is None:
        return F.regexp_count(_c(text), F.lit(rf"(?U)[^{WS[1:-1]}]+"))
    return F.size(F.filter(F.split(_c(text), pattern), lambda t: t != ""))


def truncate_tokens(text, max_tokens: int, pattern: str | None = None) -> Column:
    """The first ``max_tokens`` whitespace tokens joined by one space (M04); the rest of the text isn't cut up."""
    space = rf"(?U){WS}+" if pattern is None else pattern
    # one part more than wanted for the rest, and one for what stands before a leading separator
    parts = F.split(_c(text), space, max_tokens + 2)
    return F.array_join(F.slice(F.filter(parts, lambda t: t != ""), 1, max_tokens), " ")


# --- scoring that survives a failed job -----------------------------------------------------


def _ledger(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(folder, rows) of the finished waves under ``path``: a row for each wave."""
    from labelflow.sources.io import path_exists

    at = f"{path}/ledger"
    if not path_exists(spark, at):
        return []
    return sorted((r["folder"], r["n"]) for r in spark.read.schema("folder string, n bigint").json(at).collect())


def read_scored(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all finished waves; half-written ones don't count."""
    done = [folder for folder, _ in _ledger(spark, path)]
    return spark.read.schema(schema).parquet(*[f"{path}/{x}" for x in done]) if done else spark.createDataFrame([], schema)


def score_in_waves(df: DataFrame, make_predictor: Callable[[], Predictor], text: str, path: str, key: str = "example_id", waves: int = 20,
                   most_waves: int | None = None, **score_args) -> DataFrame:
    """``score`` in several jobs whose results are kept as they finish, so that a restart only scores the rest.

    Rows are dealt to ``waves`` by a hash of ``key``, the rows' identity, and each wave is scored and
    written under ``path`` by a job of its own; a line in the ledger then says that it counts. A
    later call with the same ``path`` leaves out the rows whose keys have been scored (an anti join)
    and deals the others anew: rows that have come since are scored too. ``most_waves`` stops after so many.
    Rows with one key are in one wave. Returns the scored rows so far.
    """
    if waves < 1:
        raise ValueError("waves must be at least 1")
    spark = df.sparkSession
    wanted = score(df.limit(0), make_predictor, text, **score_args).schema
    done = _ledger(spark, path)
    todo = df
    if done:
        seen = read_scored(spark, path, wanted).select(F.col(key).alias("__key")).distinct()
        todo = df.join(seen, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
    # dealt and written once, so that a wave reads its own rows only
    staged = scratch_dir(spark, "waves")
    wave = F.pmod(F.xxhash64(F.col(key)), F.lit(waves))
    todo.withColumn("__wave", wave).write.partitionBy("__wave").parquet(staged)
    rows = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema.fields)}, __wave bigint").parquet(staged)
    left = sorted(r[0] for r in rows.select("__wave").distinct().collect())
    for k in left[:most_waves]:
        folder = f"wave-{uuid.uuid4().hex[:12]}"
        part = rows.where(F.col("__wave") == int(k)).drop("__wave")
        score(part, make_predictor, text, **score_args).write.parquet(f"{path}/{folder}")
        n = spark.read.schema(wanted).parquet(f"{path}/{folder}").count()
        spark.createDataFrame([(folder, n)], "folder string, n bigint").coalesce(1).write.mode("append").json(f"{path}/ledger")
    return read_scored(spark, path, wanted)


def tokenizer_udf(tokenize: Callable[[str], Sequence[int]], max_tokens: int | None = None):
    """Pluggable tokenizer (M04): a pandas UDF ``text -> array<int>`` of token ids, the first ``max_tokens`` of them.

    NULL counts as empty. ``F.size`` of the result is the token count.
    """
    @F.pandas_udf("array<int>")
    def ids(s: pd.Series) -> pd.Series:
        return s.fillna("").map(lambda x: list(tokenize(x))[:max_tokens])

    return ids
