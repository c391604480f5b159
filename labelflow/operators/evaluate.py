"""Classification metrics as Spark aggregations.

Everything derives from one table, the (gold, pred) pair counts. Building it is
the only pass over the scored rows: a hash aggregate with a map-side partial
stage, so a hot label costs one partial row per task, not a hot reducer. The
counts table has at most one row per distinct (gold, pred) pair; per-label
stats, summaries and confusion tables are small aggregations over it.

Semantics follow scikit-learn with ``zero_division=0``: the label universe of
macro averages is gold ∪ predicted (hallucinated labels with support 0 dilute
macro-F1), and precision/recall/F1 are 0 on empty denominators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GOLD, PRED, COUNT = "gold", "pred", "count"


def _keys(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0.0 when den is 0 (zero_division=0)."""
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def _round(c: Column, decimals: int | None) -> Column:
    return c if decimals is None else F.round(c, decimals)


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Raise when a table lacks columns an operator reads (S06); ``sources.io.require_keys`` checks JSON files."""
    lacking = sorted(set(required) - set(df.columns))
    if lacking:
        raise ValueError(f"missing columns {lacking}; the table has {sorted(df.columns)}")


def pair_counts(df: DataFrame, gold: str = "gold_label", pred: str = "predicted_label",
                by=None) -> DataFrame:
    """(by..., gold, pred, count) over all rows with a gold label.

    A NULL prediction counts as the empty string, i.e. a wrong label. Rows without
    a gold label are no part of any metric; ``unlabelled_rows`` counts them.
    """
    keys = _keys(by)
    require_columns(df, [gold, pred, *keys])
    return (df.where(F.col(gold).isNotNull())
            .select(*keys, F.col(gold).alias(GOLD),
                    F.coalesce(F.col(pred), F.lit("")).alias(PRED))
            .groupBy(*keys, GOLD, PRED)
            .agg(F.count(F.lit(1)).alias(COUNT)))


def unlabelled_rows(df: DataFrame, gold: str = "gold_label", by=None) -> DataFrame:
    """Rows per group that the metrics leave out because their gold label is NULL: (by..., n_unlabelled, n_rows)."""
    return df.groupBy(*_keys(by)).agg(F.count_if(F.col(gold).isNull()).cast("bigint").alias("n_unlabelled"),
                                      F.count(F.lit(1)).alias("n_rows"))


def label_stats(pairs: DataFrame, by=None) -> DataFrame:
    """(by..., label, support, predicted, tp) for every label of gold ∪ pred.

    Each pair row feeds its gold label and its predicted label: one aggregation
    over the pairs table instead of two aggregations and an outer join.
    """
    keys = _keys(by)
    zero = F.lit(0).cast("bigint")
    sides = F.explode(F.array(
        F.struct(F.col(GOLD).alias("label"), F.col(COUNT).alias("s"), zero.alias("p"),
                 F.when(F.col(GOLD) == F.col(PRED), F.col(COUNT)).otherwise(zero).alias("t")),
        F.struct(F.col(PRED).alias("label"), zero.alias("s"), F.col(COUNT).alias("p"),
                 zero.alias("t")),
    )).alias("x")
    return (pairs.select(*keys, sides)
            .groupBy(*keys, F.col("x.label").alias("label"))
            .agg(F.sum("x.s").alias("support"), F.sum("x.p").alias("predicted"),
                 F.sum("x.t").alias("tp")))


def _scores(stats: DataFrame, keys: list[str]) -> DataFrame:
    s, p, t = F.col("support"), F.col("predicted"), F.col("tp")
    return stats.select(*keys, "label", "tp", "support",
                        _ratio(t, p).alias("precision"),
                        _ratio(t, s).alias("recall"),
                        _ratio(2 * t, s + p).alias("f1_score"))


def _pairs(df, gold, pred, keys, pairs):
    return pairs if pairs is not None else pair_counts(df, gold, pred, keys)


def per_label_report(df: DataFrame | None, gold: str = "gold_label", pred: str = "predicted_label",
                     by=None, decimals: int | None = None,
                     pairs: DataFrame | None = None) -> DataFrame:
    """label, precision, recall, f1_score, support; sorted by F1 desc then label.

    Ties get a total order (the reference's pandas sort leaves them unstable).
    """
    keys = _keys(by)
    sc = _scores(label_stats(_pairs(df, gold, pred, keys, pairs), keys), keys)
    return (sc.select(*keys, "label",
                      *[_round(F.col(c), decimals).alias(c) for c in ("precision", "recall", "f1_score")],
                      "support")
            .orderBy(*keys, F.col("f1_score").desc(), F.col("label").asc()))


def summary_metrics(df: DataFrame | None, gold: str = "gold_label", pred: str = "predicted_label",
                    by=None, universe: str = "union", decimals: int | None = None,
                    pairs: DataFrame | None = None) -> DataFrame:
    """accuracy, macro_f1, n_rows, n_labels; one row per ``by`` group.

    ``universe="union"`` averages F1 over gold ∪ predicted (scikit-learn's
    default); ``"gold"`` over labels with support only.
    """
    if universe not in ("union", "gold"):
        raise ValueError("universe must be 'union' or 'gold'")
    keys = _keys(by)
    sc = _scores(label_stats(_pairs(df, gold, pred, keys, pairs), keys), keys)
    inside = F.lit(True) if universe == "union" else F.col("support") > 0
    return (sc.groupBy(*keys)
            .agg(_round(_ratio(F.sum("tp"), F.sum("support")), decimals).alias("accuracy"),
                 _round(F.avg(F.when(inside, F.col("f1_score"))), decimals).alias("macro_f1"),
                 F.sum("support").alias("n_rows"),
                 F.count_if(inside).cast("bigint").alias("n_labels")))


def full_report(df: DataFrame | None, gold: str = "gold_label", pred: str = "predicted_label",
                by=None, decimals: int | None = None, pairs: DataFrame | None = None,
                labels: Sequence[str] | None = None) -> DataFrame:
    """Classification report with overall rows.

    ``labels`` fixes the label list, as the
    encoder run passes every train, validation and test label: listed labels
    without rows appear with support 0 and count in the macro average, and
    labels outside the list are neither rows nor part of the averages. The
    accuracy row stays that of all rows.

    One row per label of the universe (row_type ``label``), then ``accuracy``
    (the accuracy repeated in all four value columns, as the reference's CSV
    has it), ``macro avg`` and ``weighted avg`` (support = number of rows).
    ``support`` is a double because of the accuracy row.

    Label rows and overall rows come from one ``rollup`` over the per-label
    stats, so the scored rows are aggregated once.
    """
    keys = _keys(by)
    stats = label_stats(_pairs(df, gold, pred, keys, pairs), keys)
    if labels is not None:
        labels = sorted(set(labels))
        stats = _with_listed(stats, labels, keys)
    listed = F.lit(True) if labels is None else F.col("label").isin(labels)
    sc = _scores(stats, keys).withColumn("_in", listed)
    vals = ("precision", "recall", "f1_score")
    tot = F.sum("support")
    inside = F.sum(F.when(F.col("_in"), F.col("support")))
    agg = (sc.rollup(*keys, "label")
           .agg(*[F.avg(F.when(F.col("_in"), F.col(c))).alias(c) for c in vals],
                *[_ratio(F.sum(F.when(F.col("_in"), F.col(c) * F.col("support"))), inside).alias(f"w_{c}") for c in vals],
                _ratio(F.sum("tp"), tot).alias("acc"), tot.cast("double").alias("n"), F.bool_or("_in").alias("_in"),
                F.grouping_id(*keys, "label").alias("_gid")))
    is_total = F.col("_gid") == 1          # all keys grouped, label rolled up
    rows = F.when(~is_total, F.array(
        F.struct(F.lit("label").alias("row_type"), F.col("label"), *[F.col(c) for c in vals],
                 F.col("n").alias("support")))).otherwise(F.array(
        F.struct(F.lit("accuracy").alias("row_type"), F.lit("accuracy").alias("label"),
                 *[F.col("acc").alias(c) for c in vals], F.col("acc").alias("support")),
        F.struct(F.lit("macro avg").alias("row_type"), F.lit("macro avg").alias("label"),
                 *[F.col(c) for c in vals], F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("row_type"), F.lit("weighted avg").alias("label"),
                 *[F.col(f"w_{c}").alias(c) for c in vals], F.col("n").alias("support"))))
    out = (agg.where((F.col("_gid") == 1) | ((F.col("_gid") == 0) & F.col("_in")))
           .select(*keys, F.explode(rows).alias("r"))
           .select(*keys, "r.*"))
    order = (F.when(F.col("row_type") == "label", 0).when(F.col("row_type") == "accuracy", 1)
             .when(F.col("row_type") == "macro avg", 2).otherwise(3))
    return (out.select(*keys, "row_type", "label",
                       *[_round(F.col(c), decimals).alias(c) for c in (*vals, "support")])
            .orderBy(*keys, order, "label"))


def _with_listed(stats: DataFrame, labels: Sequence[str], keys: list[str]) -> DataFrame:
    """``stats`` with a row for every listed label in every group."""
    zero = F.lit(0).cast("bigint")
    groups = stats.select(*keys).distinct() if keys else stats.sparkSession.range(1).select()
    empty = groups.select(*keys, F.explode(F.lit(list(labels))).alias("label")).select(
        *keys, "label", *[zero.alias(c) for c in ("support", "predicted", "tp")])
    return (stats.unionByName(empty).groupBy(*keys, "label")
            .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")]))


def confusion_pairs(df: DataFrame | None, gold: str = "gold_label", pred: str = "predicted_label",
                    by=None, pairs: DataFrame | None = None) -> DataFrame:
    """Sparse confusion matrix: non-zero (gold, pred, count) cells, the canonical form."""
    keys = _keys(by)
    return _pairs(df, gold, pred, keys, pairs)


def label_universe(pairs: DataFrame) -> list[str]:
    """Sorted gold ∪ predicted labels of a pairs table: the label list of a wide confusion table."""
    return sorted(r[0] for r in pairs.select(F.explode(F.array(GOLD, PRED)).alias("label")).distinct().collect())


def confusion_wide(df: DataFrame | None, labels: Sequence[str], gold: str = "gold_label", pred: str = "predicted_label",
                   pairs: DataFrame | None = None) -> DataFrame:
    """Dense confusion matrix for a given label list: (gold, counts), counts[i] belongs to labels[i].

    One row per listed gold label; cells outside the list are dropped, as in
    scikit-learn. Positions stand for labels, which may be any strings (case
    variants, dots, quotes, newlines, the empty string).
    """
    labels = list(labels)
    if len(set(labels)) != len(labels):
        raise ValueError("labels must be different")
    pairs = _pairs(df, gold, pred, [], pairs)
    at = pairs.sparkSession.createDataFrame(list(enumerate(labels)), "at int, label string")
    cells = (pairs.join(at.select("at", F.col("label").alias(PRED)), PRED).groupBy(GOLD)
             .agg(F.map_from_entries(F.collect_list(F.struct("at", COUNT))).alias("cells")))
    counts = F.transform(F.sequence(F.lit(0), F.lit(len(labels) - 1)),
                         lambda i: F.coalesce(F.try_element_at("cells", i), F.lit(0).cast("bigint")))
    if not labels:
        return cells.select(GOLD, F.array().cast("array<bigint>").alias("counts")).limit(0)
    return at.select(F.col("label").alias(GOLD), "at").join(cells, GOLD, "left").orderBy("at").select(GOLD, counts.alias("counts"))


def top_confused_pairs(df: DataFrame | None, gold: str = "gold_label", pred: str = "predicted_label",
                       k: int = 20, by=None, pairs: DataFrame | None = None) -> DataFrame:
    """The k most frequent off-diagonal (gold, pred) pairs.

    Ties ordered by gold, pred. An all-correct input gives an empty table with
    the same schema. With ``by``, top-k within each group.
    """
    keys = _keys(by)
    off = _pairs(df, gold, pred, keys, pairs).where(F.col(GOLD) != F.col(PRED))
    if not keys:
        return off.orderBy(F.col(COUNT).desc(), GOLD, PRED).limit(k)
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(F.col(COUNT).desc(), GOLD, PRED)
    return off.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k).drop("_rk")


def oov_predictions(df: DataFrame, vocab: DataFrame, pred: str = "predicted_label",
                    label: str = "label") -> DataFrame:
    """Predicted labels outside the vocabulary, with counts.

    The vocabulary side is small; Spark broadcasts it under the auto threshold
    and shuffle-joins otherwise. Counting happens before the anti join.
    """
    counts = df.groupBy(F.col(pred).alias("predicted_label")).agg(F.count(F.lit(1)).alias("count"))
    return counts.join(vocab.select(F.col(label).alias("predicted_label")), "predicted_label", "left_anti")


def argmax_decode(logits, labels: Sequence[str] | None = None) -> Column:
    """Index of the largest logit, the first one on ties (numpy argmax).

    With ``labels`` (the sorted vocabulary, id = position) the index is decoded
    to its label string; NULL or empty arrays give NULL.
    """
    x = F.col(logits) if isinstance(logits, str) else logits
    idx = (F.array_position(x, F.array_max(x)) - 1).cast("int")
    idx = F.when(F.size(x) > 0, idx)
    if labels is None:
        return idx
    return F.get(F.array(*[F.lit(v) for v in labels]), idx)
