"""Registered scoring, ML and streaming queries."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from labelflow.operators import evaluate as ev
from labelflow.operators import ml
from labelflow.operators import score as sc
from labelflow.operators import vocab as V
from labelflow.plans import fixtures as fx
from labelflow.plans import oracle_sql as O
from labelflow.plans.chat_queries import _PREP_SQL, _flat
from labelflow.plans.registry import register
from labelflow.plans.text_queries import _CASCADE, _F3_VOCAB, _f3
from labelflow.session import scratch_dir
from labelflow.streaming import stream as st


def keyword_model():
    """Deterministic stand-in for a generative model: answers ``label: <language>`` from function words.

    Built once per Python worker by ``predict_batch_udf``.
    """
    splitter = re.compile("[ .,\n]+")
    words = {lang: set(ws) for lang, ws in fx.FUNCTION_WORDS.items()}

    def predict(texts):
        out = []
        for t in texts:
            toks = splitter.split(t.lower())
            counts = {lang: sum(1 for x in toks if x in ws) for lang, ws in words.items()}
            best = max(counts.values())
            guess = "none" if best <= 0 else min(lang for lang, c in counts.items() if c == best)
            out.append(f"label: {guess}")
        return out

    return predict


_LANGS_SQL = "(SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)"


@register("score_with_stub_model", O.with_(O.F2_GUESS_B_CTE) + f"""
SELECT d.doc_id AS example_id, d.text AS utterance, d.lang AS gold_label,
  CASE WHEN g.guess IN {_LANGS_SQL} THEN g.guess ELSE 'label: ' || g.guess END AS predicted_label,
  'label: ' || g.guess AS raw_prediction, 'zero-shot' AS mode, 'stub/keyword-v1' AS model_name
FROM documents d JOIN guess_b g USING (doc_id)""")
def score_with_stub_model(spark, sf):
    d = fx.table(spark, sf, "documents")
    labels = V.collect_labels(d.select(F.col("lang").alias("label")))
    rows = d.select(F.col("doc_id").alias("example_id"), F.col("text").alias("utterance"),
                    F.col("lang").alias("gold_label"))
    scored = sc.score(rows, keyword_model, "utterance", labels, strategy="cascade", batch_size=128)
    return sc.prediction_records(scored, mode="zero-shot", model_name="stub/keyword-v1")


@register("stub_model_metrics", O.with_(O.F2_GUESS_B_CTE, f"""
src AS (
  SELECT d.lang AS gold_label,
    CASE WHEN g.guess IN {_LANGS_SQL} THEN g.guess ELSE 'label: ' || g.guess END AS predicted_label
  FROM documents d JOIN guess_b g USING (doc_id)
)""", O.metric_ctes()) + "\n" + O.summary_sql())
def stub_model_metrics(spark, sf):
    return ev.summary_metrics(score_with_stub_model(spark, sf), decimals=10)


@register("truncate_tokens", """
SELECT doc_id AS example_id,
  CAST(len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS INTEGER) AS n_tokens,
  array_to_string(list_slice(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''), 1, 64), ' ') AS truncated
FROM documents""")
def truncate_tokens(spark, sf):
    d = fx.table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("example_id"), sc.token_count("text").alias("n_tokens"),
                    sc.truncate_tokens("text", 64).alias("truncated"))


_SPLITS_SQL = O.with_(_PREP_SQL)


@register("train_text_classifier", _SPLITS_SQL + """
SELECT split, count(*) AS n_rows, count(DISTINCT label) AS n_labels, TRUE AS good
FROM prep WHERE split IN ('val', 'test') GROUP BY split""")
def train_text_classifier(spark, sf):
    """Spark ML baseline trained on the train split and scored on validation and test; ``good``: more than half are right."""
    flat = _flat(spark, sf)
    labels = V.collect_labels(flat.select("label"))
    model = ml.text_classifier(max_iter=30, labels=labels).fit(flat.where(F.col("split") == "train"))
    pred = ml.predict_labels(model, flat.where(F.col("split") != "train"))
    return pred.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("label").alias("n_labels"),
        (F.avg((F.col("label") == F.col("predicted_label")).cast("double")) > 0.5).alias("good"))


_GRID = (0.0, 0.01, 0.1)


@register("sweep_regularisation", O.with_(_PREP_SQL, """
b AS (SELECT example_id, label, md5('42' || '|' || CAST(example_id AS VARCHAR)) AS h FROM prep WHERE split = 'train'),
c AS (SELECT label, count(*) AS n FROM b GROUP BY label),
r AS (SELECT b.*, n, row_number() OVER (PARTITION BY label ORDER BY h, example_id) - 1 AS pos FROM b JOIN c USING (label)),
v AS (SELECT count(*) FILTER (WHERE pos >= round(CAST(0.2 AS DOUBLE) * n)) AS n_train, count(*) FILTER (WHERE pos < round(CAST(0.2 AS DOUBLE) * n)) AS n_validation FROM r)""") + f"""
SELECT g.reg_param, n_train, n_validation, TRUE AS good, CAST(1 AS BIGINT) AS n_chosen, TRUE AS chosen_is_best
FROM v, (SELECT unnest({[float(x) for x in _GRID]})::DOUBLE AS reg_param) g""")
def sweep_regularisation(spark, sf):
    """Regularisation sweep; one run is chosen, by validation macro-F1."""
    train = _flat(spark, sf).where(F.col("split") == "train")
    runs, _ = ml.sweep(train, _GRID, max_iter=20)
    every = Window.partitionBy()  # one row per grid point
    return runs.select("reg_param", "n_train", "n_validation", (F.col("accuracy") > 0.5).alias("good"),
                       F.sum(F.col("chosen").cast("bigint")).over(every).alias("n_chosen"),
                       (F.max(F.when(F.col("chosen"), F.col("macro_f1"))).over(every) == F.max("macro_f1").over(every)).alias("chosen_is_best"))


# --- streams ----------------------------------------------------------------------------

def _f3_stream(spark, sf):
    rows, labels = _f3(spark, sf)
    src = scratch_dir(spark, "f3_incoming")
    rows.write.parquet(src)
    return st.read_stream(spark, src, "example_id bigint, gold_label string, raw_prediction string",
                          max_files_per_trigger=1000), labels


@register("stream_extract", O.with_(O.F3_CTE, _F3_VOCAB) + f"""
SELECT example_id, gold_label, raw_prediction, {_CASCADE} AS predicted_label FROM src, v""")
def stream_extract(spark, sf):
    s, labels = _f3_stream(spark, sf)
    out, ckpt = scratch_dir(spark, "extract_out"), scratch_dir(spark, "extract_ckpt")
    st.append_to_files(st.extract_stream(s, labels), out, ckpt).awaitTermination()
    return spark.read.parquet(out)


_STREAM_PAIRS_SQL = O.with_(O.F3_CTE, _F3_VOCAB, f"""
ex AS (SELECT gold_label, {_CASCADE} AS predicted_label FROM src, v)""", O.metric_ctes(src="ex"))


@register("stream_confusion", _STREAM_PAIRS_SQL + "\nSELECT gold, pred, CAST(cnt AS BIGINT) AS count FROM pairs")
def stream_confusion(spark, sf):
    s, labels = _f3_stream(spark, sf)
    return st.complete_to_table(st.confusion_stream(st.extract_stream(s, labels)), spark, "confusion")


@register("stream_metrics", _STREAM_PAIRS_SQL + "\n" + O.summary_sql())
def stream_metrics(spark, sf):
    s, labels = _f3_stream(spark, sf)
    pairs = st.complete_to_table(st.confusion_stream(st.extract_stream(s, labels)), spark, "confusion")
    return ev.summary_metrics(None, pairs=pairs, decimals=10)


@register("stream_append_predictions", O.with_(O.f2_cte("a")) + """
SELECT example_id, utterance, gold_label, predicted_label, 'zero-shot' AS mode, 'guesser_a' AS model_name FROM src""")
def stream_append_predictions(spark, sf):
    src = scratch_dir(spark, "f2_incoming")
    fx.f2_predictions(spark, sf, "a").write.parquet(src)
    s = st.read_stream(spark, src, "example_id bigint, utterance string, gold_label string, predicted_label string",
                       max_files_per_trigger=1000)
    recs = sc.prediction_records(s, raw=None, mode="zero-shot", model_name="guesser_a")
    out, ckpt = scratch_dir(spark, "pred_out"), scratch_dir(spark, "pred_ckpt")
    st.append_to_files(recs, out, ckpt).awaitTermination()
    return spark.read.parquet(out)


@register("stream_score_with_stub_model", O.with_(O.F2_GUESS_B_CTE) + f"""
SELECT d.doc_id AS example_id, d.text AS utterance, d.lang AS gold_label,
  CASE WHEN g.guess IN {_LANGS_SQL} THEN g.guess ELSE 'label: ' || g.guess END AS predicted_label,
  'label: ' || g.guess AS raw_prediction, 'zero-shot' AS mode, 'stub/keyword-v1' AS model_name
FROM documents d JOIN guess_b g USING (doc_id)""")
def stream_score_with_stub_model(spark, sf):
    """Utterances arriving as files are scored, extracted and appended as they come."""
    d = fx.table(spark, sf, "documents")
    labels = V.collect_labels(d.select(F.col("lang").alias("label")))
    src = scratch_dir(spark, "utterances_incoming")
    d.select(F.col("doc_id").alias("example_id"), F.col("text").alias("utterance"),
             F.col("lang").alias("gold_label")).write.parquet(src)
    s = st.read_stream(spark, src, "example_id bigint, utterance string, gold_label string",
                       max_files_per_trigger=1000)
    scored = sc.score(s, keyword_model, "utterance", labels, strategy="cascade", batch_size=128)
    recs = sc.prediction_records(scored, mode="zero-shot", model_name="stub/keyword-v1")
    out, ckpt = scratch_dir(spark, "scored_out"), scratch_dir(spark, "scored_ckpt")
    st.append_to_files(recs, out, ckpt).awaitTermination()
    return spark.read.parquet(out)


@register("score_in_waves", O.with_(O.F2_GUESS_B_CTE) + f"""
SELECT d.doc_id AS example_id, d.text AS utterance, d.lang AS gold_label,
  CASE WHEN g.guess IN {_LANGS_SQL} THEN g.guess ELSE 'label: ' || g.guess END AS predicted_label,
  'label: ' || g.guess AS raw_prediction, 'zero-shot' AS mode, 'stub/keyword-v1' AS model_name
FROM documents d JOIN guess_b g USING (doc_id)""")
def score_in_waves(spark, sf):
    """M01 stopped after two of five waves and taken up again: the same records as in one go."""
    d = fx.table(spark, sf, "documents")
    labels = V.collect_labels(d.select(F.col("lang").alias("label")))
    rows = d.select(F.col("doc_id").alias("example_id"), F.col("text").alias("utterance"), F.col("lang").alias("gold_label"))
    path = scratch_dir(spark, "scored_waves")
    sc.score_in_waves(rows, keyword_model, "utterance", path, waves=5, most_waves=2, labels=labels)
    scored = sc.score_in_waves(rows, keyword_model, "utterance", path, waves=5, labels=labels)
    return sc.prediction_records(scored, mode="zero-shot", model_name="stub/keyword-v1")


@register("stream_confusion_replayed", _STREAM_PAIRS_SQL + "\nSELECT gold, pred, CAST(cnt AS BIGINT) AS count FROM pairs")
def stream_confusion_replayed(spark, sf):
    """T02 by each batch's counts: a batch that comes again counts once."""
    s, labels = _f3_stream(spark, sf)
    counts = st.PairCounts(spark, scratch_dir(spark, "pair_counts"), merge_every=3)

    def add(batch, number):
        counts.add(batch, number)
        counts.add(batch, number)  # as after a failure between the write and its checkpoint

    labelled = st.extract_stream(s, labels).where(F.col("gold_label").isNotNull())
    pairs = labelled.select(F.col("gold_label").alias(ev.GOLD), F.coalesce("predicted_label", F.lit("")).alias(ev.PRED))
    pairs.writeStream.option("checkpointLocation", scratch_dir(spark, "pair_ckpt")).foreachBatch(add).trigger(availableNow=True).start().awaitTermination()
    return counts.read()
