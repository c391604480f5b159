"""Registered comparison, run-selection and curve queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelflow.operators import compare as C
from labelflow.operators import evaluate as ev
from labelflow.plans import fixtures as fx
from labelflow.plans import oracle_sql as O
from labelflow.plans.registry import register

D = 10
_G = ("a", "b", "c", "d")
_MODELS = tuple(f"guesser_{g}" for g in _G)

# --- epoch metrics -----------------------------------------------------------------------

_EPOCH_VALUES = ", ".join(f"('{r}', {e}, {m})" for r, e, m in fx.EPOCH_MODULI)
_EPOCH_SRC = f"""
params AS (SELECT * FROM (VALUES {_EPOCH_VALUES}) t(run, epoch, m)),
src AS (
  SELECT p.run, p.epoch, d.lang AS gold_label,
    CASE WHEN d.doc_id % p.m = 0 THEN 'xx' ELSE d.lang END AS predicted_label
  FROM documents d, params p
)"""
_EPOCH_SQL = O.with_(_EPOCH_SRC, O.metric_ctes(("run", "epoch")), "em AS (" + O.summary_sql(("run", "epoch")) + ")")


def _epochs(spark, sf):
    return ev.summary_metrics(fx.f4_epoch_predictions(spark, sf), by=("run", "epoch"), decimals=D)


@register("epoch_metrics", _EPOCH_SQL + "\nSELECT * FROM em")
def epoch_metrics(spark, sf):
    return _epochs(spark, sf)


@register("best_epoch", _EPOCH_SQL + """
SELECT run, epoch AS best_epoch, macro_f1 AS best_macro_f1, accuracy AS best_accuracy FROM (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY macro_f1 DESC, accuracy DESC, epoch ASC) AS rk FROM em)
WHERE rk = 1""")
def best_epoch(spark, sf):
    return C.best_epoch(_epochs(spark, sf))


@register("early_stop_epoch", _EPOCH_SQL + """,
f AS (
  SELECT run, epoch, row_number() OVER w AS rn,
    macro_f1 > coalesce(max(macro_f1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1e308) AS imp
  FROM em WINDOW w AS (PARTITION BY run ORDER BY epoch)
),
s AS (
  SELECT run, epoch,
    rn - max(CASE WHEN imp THEN rn END) OVER (PARTITION BY run ORDER BY epoch
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak
  FROM f
)
SELECT run, min(epoch) FILTER (WHERE streak >= 2) AS stop_epoch, max(epoch) AS last_epoch FROM s GROUP BY run""")
def early_stop_epoch(spark, sf):
    return C.early_stop_epoch(_epochs(spark, sf), patience=2)


@register("stream_early_stop", _EPOCH_SQL + """,
f AS (
  SELECT run, epoch, row_number() OVER w AS rn,
    macro_f1 > coalesce(max(macro_f1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1e308) AS imp
  FROM em WINDOW w AS (PARTITION BY run ORDER BY epoch)
),
s AS (
  SELECT run, epoch,
    rn - max(CASE WHEN imp THEN rn END) OVER (PARTITION BY run ORDER BY epoch
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak
  FROM f
)
SELECT run, CAST(min(epoch) AS INTEGER) AS stop_epoch FROM s WHERE streak >= 1 GROUP BY run""")
def stream_early_stop(spark, sf):
    """A14 as evaluations come in, epoch by epoch in two runs of the stream over one checkpoint; patience 1."""
    from labelflow.session import scratch_dir
    from labelflow.streaming import stream as st

    epochs = _epochs(spark, sf).select("run", F.col("epoch").cast("int").alias("epoch"), "macro_f1").checkpoint(eager=True)
    src, out, ckpt = (scratch_dir(spark, f"stop_{x}") for x in ("incoming", "out", "ckpt"))
    for some in (F.col("epoch") <= 2, F.col("epoch") > 2):
        epochs.where(some).write.mode("append").parquet(src)
        st.append_to_files(st.early_stop_stream(st.read_stream(spark, src, "run string, epoch int, macro_f1 double"), patience=1), out, ckpt).awaitTermination()
    return spark.read.schema("run string, stop_epoch int").parquet(out)


# --- model comparison over metric records -------------------------------------------------

_BY = ("model_name",)
_MODEL_SUMMARY_SQL = O.with_(O.f2_stacked_cte(_G), O.metric_ctes(_BY), "ms AS (" + O.summary_sql(_BY) + ")")


def _metric_records(spark, sf, drop_both_for=()):
    """Per-model metric records as the reference's JSON files hold them: the encoder run
    (guesser_a) under ``test_`` keys, the others under plain keys."""
    s = ev.summary_metrics(fx.f2_stacked(spark, sf, _G), by="model_name", decimals=D)
    enc = F.col("model_name") == "guesser_a"
    gone = F.col("model_name").isin(*drop_both_for) if drop_both_for else F.lit(False)
    none = F.lit(None).cast("double")
    return s.select(F.col("model_name").alias("model"),
                    F.when(enc | gone, none).otherwise(F.col("accuracy")).alias("accuracy"),
                    F.when(enc | gone, none).otherwise(F.col("macro_f1")).alias("macro_f1"),
                    F.when(enc & ~gone, F.col("accuracy")).otherwise(none).alias("test_accuracy"),
                    F.when(enc & ~gone, F.col("macro_f1")).otherwise(none).alias("test_macro_f1"))


@register("model_comparison", _MODEL_SUMMARY_SQL + """
SELECT model_name AS model, accuracy, macro_f1 FROM ms
WHERE model_name IN ('guesser_a', 'guesser_b', 'guesser_c', 'guesser_d', 'guesser_e')""")
def model_comparison(spark, sf):
    recs = _metric_records(spark, sf)
    return C.model_comparison(recs, required=("guesser_a", "guesser_b", "guesser_c"),
                              optional=("guesser_d", "guesser_e"), prefixed_first=("guesser_a",))


@register("metric_fallback", _MODEL_SUMMARY_SQL + """
SELECT model_name AS model,
  CASE WHEN model_name = 'guesser_c' THEN 0.0 ELSE accuracy END AS accuracy,
  CASE WHEN model_name = 'guesser_c' THEN 0.0 ELSE macro_f1 END AS macro_f1
FROM ms""")
def metric_fallback(spark, sf):
    recs = _metric_records(spark, sf, drop_both_for=("guesser_c",))
    return recs.select("model", C.get_metric("accuracy", "test_accuracy", "default").alias("accuracy"),
                       C.get_metric("macro_f1", "test_macro_f1", "default").alias("macro_f1"))


@register("missing_models", _MODEL_SUMMARY_SQL + """
SELECT model FROM (VALUES ('guesser_a'), ('guesser_b'), ('guesser_c'), ('guesser_d'), ('guesser_e')) t(model)
WHERE model NOT IN (SELECT model_name FROM ms)""")
def missing_models(spark, sf):
    return C.missing_models(_metric_records(spark, sf), ("guesser_a", "guesser_b", "guesser_c", "guesser_d",
                                                         "guesser_e"))


# --- per-row comparisons ---------------------------------------------------------------------

_WIDE_SQL = O.F2_GUESS_B_CTE + f""",
wide AS (
  SELECT d.doc_id AS example_id, d.lang AS gold_label, {O.F2_GUESS_A} AS guesser_a, g.guess AS guesser_b,
    {O.F2_GUESS_C} AS guesser_c, {O.F2_GUESS_D} AS guesser_d
  FROM documents d JOIN guess_b g USING (doc_id)
)"""


@register("predictions_side_by_side", O.with_(_WIDE_SQL) + "\nSELECT * FROM wide")
def predictions_side_by_side(spark, sf):
    return C.side_by_side(fx.f2_stacked(spark, sf, _G), _MODELS)


@register("model_agreement", O.with_(_WIDE_SQL) + """
SELECT example_id, guesser_a, guesser_b, guesser_c, guesser_d,
  CAST(len(list_distinct([guesser_a, guesser_b, guesser_c, guesser_d])) AS INTEGER) AS n_distinct,
  CASE len(list_distinct([guesser_a, guesser_b, guesser_c, guesser_d]))
    WHEN 1 THEN '✅ All 4 models agree' WHEN 2 THEN '⚠️ Models partially disagree' ELSE '❌ Models mostly disagree' END AS note
FROM wide""")
def model_agreement(spark, sf):
    d = fx.table(spark, sf, "documents")
    wide = d.select(F.col("doc_id").alias("example_id"), fx.guess_a().alias("guesser_a"),
                    fx.guess_language().alias("guesser_b"), fx.guess_c().alias("guesser_c"),
                    fx.guess_d().alias("guesser_d"))
    return C.model_agreement(wide, _MODELS, keep=("example_id",))


@register("zip_predictions", O.with_(O.f2_cte("b")) + """
SELECT example_id, gold_label, predicted_label FROM src""")
def zip_predictions(spark, sf):
    gold = fx.f2_predictions(spark, sf, "a").select("example_id", "gold_label")
    preds = fx.f2_predictions(spark, sf, "b").select("example_id", "predicted_label")
    return C.zip_predictions(gold, preds)


# --- training curves ---------------------------------------------------------------------------

_LOSS_SQL = """
ev AS (
  SELECT user_id AS run, event_id, ts,
    CASE WHEN event_id % 6 = 0 THEN NULL ELSE value END AS train_mean_nll,
    (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id))::DOUBLE
      / count(*) OVER (PARTITION BY user_id) AS progress
  FROM events
)"""


@register("progress_percent", O.with_(_LOSS_SQL) + """
SELECT run, event_id, round(progress * 100, 10) AS progress_pct FROM ev""")
def progress_percent(spark, sf):
    log = fx.f4_loss_log(spark, sf)
    return log.select("run", "event_id", F.round(C.progress_percent("progress"), D).alias("progress_pct"))


@register("rolling_loss", O.with_(_LOSS_SQL) + """
SELECT run, event_id, round(progress * 100, 10) AS progress_pct, train_mean_nll,
  row_number() OVER w - 1 AS step,
  round(avg(train_mean_nll) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 10) AS smoothed
FROM ev WHERE train_mean_nll IS NOT NULL
WINDOW w AS (PARTITION BY run ORDER BY ts, event_id)""")
def rolling_loss(spark, sf):
    log = fx.f4_loss_log(spark, sf)
    sm = C.rolling_mean(log, "run", ["ts", "event_id"], "train_mean_nll", window=5)
    return sm.select("run", "event_id", F.round(C.progress_percent("progress"), D).alias("progress_pct"),
                     "train_mean_nll", "step", F.round("smoothed", D).alias("smoothed"))
