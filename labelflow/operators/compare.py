"""Model comparison, run selection and training curves
(A10, A12-A14, S11, J05-J07, W01, P18).

Metric tables here are small (one row per model, run or epoch) except the
per-row agreement / side-by-side tables and the loss logs, which keep their
row count and are built with skew-safe ordinals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelflow.operators.sampling import group_ordinal

# Agreement notes shown by the reference's demo for 1, 2, 3+ distinct answers.
AGREE_ALL = "✅ All {n} models agree"
AGREE_PARTIAL = "⚠️ Models partially disagree"
AGREE_NONE = "❌ Models mostly disagree"


def get_metric(primary: str, fallback: str, on_missing: str = "raise", default: float = 0.0) -> Column:
    """``metrics.get(primary, metrics.get(fallback))`` over nullable metric columns.

    ``on_missing="raise"`` fails the job like the comparison script;
    ``"default"`` returns ``default`` like the curve script.
    """
    v = F.coalesce(F.col(primary), F.col(fallback)).cast("double")
    if on_missing == "raise":
        return F.when(v.isNull(), F.raise_error(F.lit(f"a metrics row has neither {primary} nor {fallback}")))\
                .otherwise(v)
    if on_missing == "default":
        return F.coalesce(v, F.lit(float(default)))
    raise ValueError("on_missing must be 'raise' or 'default'")


def model_comparison(metrics: DataFrame, required: Sequence[str] = (), optional: Sequence[str] | None = None,
                     model: str = "model", prefixed_first: Sequence[str] = ()) -> DataFrame:
    """One row per model with accuracy and macro_f1.

    ``metrics`` holds nullable ``accuracy, macro_f1, test_accuracy, test_macro_f1``;
    models in ``prefixed_first`` read the ``test_`` keys first (the encoder's
    file), others the plain keys first. A required model missing from
    ``metrics`` raises at once; optional ones are simply absent. With
    ``optional=None`` every model present is kept.
    """
    pref = F.col(model).isin(*prefixed_first) if prefixed_first else F.lit(False)
    acc = F.when(pref, get_metric("test_accuracy", "accuracy")).otherwise(get_metric("accuracy", "test_accuracy"))
    f1 = F.when(pref, get_metric("test_macro_f1", "macro_f1")).otherwise(get_metric("macro_f1", "test_macro_f1"))
    out = metrics.select(F.col(model).alias("model"), acc.alias("accuracy"), f1.alias("macro_f1"))
    if optional is not None:
        out = out.where(F.col("model").isin(*required, *optional))
    if required:
        found = {r[0] for r in out.where(F.col("model").isin(*required)).select("model").distinct().collect()}
        lacking = [m for m in required if m not in found]
        if lacking:
            raise ValueError(f"no metrics for the required models {lacking}")
    return out


def missing_models(metrics: DataFrame, expected: Sequence[str], model: str = "model") -> DataFrame:
    """Expected experiments without a metrics row: the reference's skip notices."""
    exp = metrics.sparkSession.createDataFrame([(m,) for m in expected], "model string")
    return exp.join(metrics.select(F.col(model).alias("model")).distinct(), "model", "left_anti")


def best_epoch(epochs: DataFrame, run: str = "run", epoch: str = "epoch", metric: str = "macro_f1",
               tie: str = "accuracy") -> DataFrame:
    """Per run, the epoch with the best ``metric`` (ties: ``tie`` desc, then earliest)."""
    key = F.struct(F.col(metric), F.col(tie), -F.col(epoch))
    return (epochs.groupBy(run)
            .agg(F.max_by(F.struct(F.col(epoch).alias("best_epoch"), F.col(metric).alias(f"best_{metric}"),
                                   F.col(tie).alias(f"best_{tie}")), key).alias("b"))
            .select(run, "b.*"))


def early_stop_epoch(epochs: DataFrame, run: str = "run", epoch: str = "epoch", metric: str = "macro_f1",
                     patience: int = 2) -> DataFrame:
    """Per run, the first epoch at which ``metric`` has not improved on its best for ``patience``
    evaluations in a row (NULL if training runs out first) (A14)."""
    w = Window.partitionBy(run).orderBy(epoch)
    prev_best = F.max(metric).over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = epochs.select(run, epoch, metric, F.row_number().over(w).alias("_rn"),
                            (F.col(metric) > F.coalesce(prev_best, F.lit(float("-inf")))).alias("_imp"))
    last_imp = F.max(F.when(F.col("_imp"), F.col("_rn"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    streak = flagged.select(run, epoch, (F.col("_rn") - last_imp).alias("_streak"))
    return (streak.groupBy(run)
            .agg(F.min(F.when(F.col("_streak") >= patience, F.col(epoch))).alias("stop_epoch"),
                 F.max(epoch).alias("last_epoch")))


def model_agreement(df: DataFrame, pred_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Distinct answers per row across models and the reference's note."""
    n = F.size(F.array_distinct(F.array(*[F.col(c) for c in pred_cols])))
    note = (F.when(n == 1, F.lit(AGREE_ALL.format(n=len(pred_cols))))
            .when(n == 2, F.lit(AGREE_PARTIAL)).otherwise(F.lit(AGREE_NONE)))
    return df.select(*keep, *pred_cols, n.alias("n_distinct"), note.alias("note"))


def side_by_side(stacked: DataFrame, models: Sequence[str], key: str = "example_id",
                 model: str = "model_name", pred: str = "predicted_label",
                 carry: Sequence[str] = ("gold_label",)) -> DataFrame:
    """Long (key, model, pred) -> one row per key with a column per model.

    The model list is explicit, so the pivot plans no extra distinct job; the
    aggregation is keyed by the example id (no hot key).
    """
    return (stacked.groupBy(key, *carry).pivot(model, list(models)).agg(F.first(pred)))


def zip_predictions(gold: DataFrame, preds: DataFrame, key: str = "example_id") -> DataFrame:
    """Positional zip of utterances, gold and predictions as an equi-join on the row key."""
    return gold.join(preds, key, "inner")


def rolling_mean(df: DataFrame, group: str, order: Sequence[str] | str, value: str, window: int = 5,
                 out: str = "smoothed", position: str = "step", bucket: int = 100_000) -> DataFrame:
    """``rolling(window, min_periods=1).mean()`` per group after dropping NULL values.

    Skew-safe: rows get their position inside the group from ``group_ordinal``
    and fall into buckets of ``bucket`` positions; the last ``window - 1`` rows of
    a bucket are copied into the next one, a plain window runs inside
    (group, bucket), and the copies are dropped.
    """
    rows = df.where(F.col(value).isNotNull())
    pos = group_ordinal(rows, group, order, out=position)
    mine = F.floor(F.col(position) / bucket)
    into = F.when(F.col(position) % bucket >= bucket - (window - 1), F.array(mine, mine + 1)).otherwise(F.array(mine))
    spread = pos.select(*pos.columns, mine.alias("_mine"), F.explode(into).alias("_bucket"))
    back = Window.partitionBy(group, "_bucket").orderBy(position).rowsBetween(-(window - 1), 0)
    return (spread.withColumn(out, F.avg(value).over(back)).where(F.col("_mine") == F.col("_bucket"))
            .select(*pos.columns, out))


def progress_percent(progress: str = "progress") -> Column:
    """Training progress (0..1) as percent."""
    return F.col(progress) * 100
