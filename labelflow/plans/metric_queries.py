"""Registered evaluation queries (A01-A07, A15, A16, X07 support)."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelflow.operators import evaluate as ev
from labelflow.plans import fixtures as fx
from labelflow.plans import oracle_sql as O
from labelflow.plans.registry import register

D = 10  # decimals kept in metric outputs (the reference's metrics writer keeps 10)


@register("summary_metrics", O.with_(O.f2_cte("a"), O.metric_ctes()) + "\n" + O.summary_sql())
def summary_metrics(spark, sf):
    return ev.summary_metrics(fx.f2_predictions(spark, sf, "a"), decimals=D)


@register("summary_metrics_gold_universe",
          O.with_(O.f2_cte("a"), O.metric_ctes()) + "\n" + O.summary_sql(universe="gold"))
def summary_metrics_gold_universe(spark, sf):
    return ev.summary_metrics(fx.f2_predictions(spark, sf, "a"), universe="gold", decimals=D)


@register("summary_metrics_guesser_b", O.with_(O.f2_cte("b"), O.metric_ctes()) + "\n" + O.summary_sql())
def summary_metrics_guesser_b(spark, sf):
    return ev.summary_metrics(fx.f2_predictions(spark, sf, "b"), decimals=D)


@register("per_label_report", O.with_(O.f2_cte("a"), O.metric_ctes()) + "\n" + O.per_label_sql())
def per_label_report(spark, sf):
    return ev.per_label_report(fx.f2_predictions(spark, sf, "a"), decimals=D)


@register("full_report", O.with_(O.f2_cte("a"), O.metric_ctes()) + "\n" + O.full_report_sql())
def full_report(spark, sf):
    return ev.full_report(fx.f2_predictions(spark, sf, "a"), decimals=D)


_BY = ("model_name", "mode")


@register("summary_metrics_by_model",
          O.with_(O.f2_stacked_cte(("a", "b", "c", "d")), O.metric_ctes(_BY)) + "\n" + O.summary_sql(_BY))
def summary_metrics_by_model(spark, sf):
    return ev.summary_metrics(fx.f2_stacked(spark, sf, ("a", "b", "c", "d")), by=_BY, decimals=D)


@register("per_label_report_by_model",
          O.with_(O.f2_stacked_cte(("a", "b")), O.metric_ctes(_BY)) + "\n" + O.per_label_sql(_BY))
def per_label_report_by_model(spark, sf):
    return ev.per_label_report(fx.f2_stacked(spark, sf, ("a", "b")), by=_BY, decimals=D)


# The same guesser scored with and without the out-of-scope class.
_OOS_GUESS_SQL = "CASE WHEN example_id % 7 = 0 THEN 'oos' WHEN example_id % 5 = 0 THEN 'fr' ELSE lang END"


def _oos_rows(spark, sf):
    """F1 gold labels with the guesser, from one scan of documents (F1 is a projection of it)."""
    d = fx.table(spark, sf, "documents")
    f1 = fx.f1_columns()
    guess = (F.when((F.col("doc_id") % 7) == 0, "oos").when((F.col("doc_id") % 5) == 0, "fr")
             .otherwise(F.col("lang")))
    return (d.select(F.col("doc_id").alias("example_id"), f1["text"].alias("text"),
                     f1["label_text"].alias("gold_label"), guess.alias("predicted_label"))
            .where(F.col("text").isNotNull() & F.col("gold_label").isNotNull())
            .drop("text"))


def metrics_with_without_oos_df(rows):
    both = rows.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("include_oos"))
    kept = both.where(F.col("include_oos") | (F.col("gold_label") != "oos"))
    return ev.summary_metrics(kept, by="include_oos", decimals=D)


@register("metrics_with_without_oos", O.with_(O.F1_CTE, f"""
rows AS (
  SELECT s.example_id, s.label_text AS gold_label, {_OOS_GUESS_SQL} AS predicted_label
  FROM src s JOIN (SELECT doc_id AS example_id, lang FROM documents) d USING (example_id)
  WHERE s.text IS NOT NULL AND s.label_text IS NOT NULL
),
both_ AS (
  SELECT *, TRUE AS include_oos FROM rows
  UNION ALL
  SELECT *, FALSE AS include_oos FROM rows WHERE gold_label <> 'oos'
)""", O.metric_ctes(("include_oos",), src="both_")) + "\n" + O.summary_sql(("include_oos",)))
def metrics_with_without_oos(spark, sf):
    return metrics_with_without_oos_df(_oos_rows(spark, sf))


@register("confusion_pairs", O.with_(O.f2_cte("a"), O.metric_ctes()) +
          "\nSELECT gold, pred, CAST(cnt AS BIGINT) AS count FROM pairs")
def confusion_pairs(spark, sf):
    return ev.confusion_pairs(fx.f2_predictions(spark, sf, "a"))


_F2_LABELS = ("de", "en", "es", "fr", "xx")


def _wide_sql(labels):
    cols = ",\n  ".join(f"CAST(coalesce(sum(CASE WHEN p.pred = '{x}' THEN p.cnt END), 0) AS BIGINT) AS {x}"
                        for x in labels)
    return f"""
SELECT u.label AS gold,
  {cols}
FROM (SELECT gold AS label FROM pairs UNION SELECT pred FROM pairs) u
LEFT JOIN pairs p ON p.gold = u.label
GROUP BY u.label"""


@register("confusion_wide", O.with_(O.f2_cte("a"), O.metric_ctes()) + _wide_sql(_F2_LABELS))
def confusion_wide(spark, sf):
    return _columns(ev.confusion_wide(fx.f2_predictions(spark, sf, "a"), _F2_LABELS), _F2_LABELS)


def _columns(wide, labels):
    """A column per label, for labels that are plain names."""
    return wide.select("gold", *[F.col("counts")[i].alias(x) for i, x in enumerate(labels)])


# A05, A06, J03 on raw model text: case variants, dots, quotes, newlines, 'gold' and ''.
@register("confusion_any_labels", O.with_(O.F3_CTE, """
prs AS (
  SELECT gold_label AS gold, CASE WHEN example_id % 24 = 0 THEN 'gold' WHEN example_id % 24 = 6 THEN 'a.`b`' ELSE raw_prediction END AS pred
  FROM src
),
u AS (SELECT gold AS label FROM prs UNION SELECT pred FROM prs),
cells AS (SELECT gold, pred, count(*) AS n FROM prs GROUP BY gold, pred)""") + """
SELECT g.label AS gold, string_agg(CAST(coalesce(c.n, 0) AS VARCHAR), ',' ORDER BY p.label) AS counts
FROM u g CROSS JOIN u p LEFT JOIN cells c ON c.gold = g.label AND c.pred = p.label
GROUP BY g.label""")
def confusion_any_labels(spark, sf):
    raw = F.when(F.col("example_id") % 24 == 0, "gold").when(F.col("example_id") % 24 == 6, "a.`b`").otherwise(F.col("raw_prediction"))
    rows = fx.f3_raw_outputs(spark, sf).select("gold_label", raw.alias("predicted_label"))
    pairs = ev.pair_counts(rows)
    wide = ev.confusion_wide(None, ev.label_universe(pairs), pairs=pairs)
    return wide.select("gold", F.array_join(F.col("counts").cast("array<string>"), ",").alias("counts"))


# A04 with a fixed label list: 'it' and 'zh' have no rows, 'xx' is not listed.
_FIXED = ("de", "en", "es", "fr", "it", "zh")


@register("full_report_fixed_labels", O.with_(O.f2_cte("a"), f"""
l AS (SELECT unnest({list(_FIXED)}) AS label),
st AS (
  SELECT l.label, (SELECT count(*) FROM src WHERE gold_label = l.label) AS s,
    (SELECT count(*) FROM src WHERE predicted_label = l.label) AS p,
    (SELECT count(*) FROM src WHERE gold_label = l.label AND predicted_label = l.label) AS t
  FROM l
),
m AS (
  SELECT label, s, CASE WHEN p > 0 THEN t::DOUBLE / p ELSE 0 END AS precision, CASE WHEN s > 0 THEN t::DOUBLE / s ELSE 0 END AS recall,
    CASE WHEN s + p > 0 THEN 2 * t::DOUBLE / (s + p) ELSE 0 END AS f1_score
  FROM st
),
a AS (SELECT avg(CASE WHEN gold_label = predicted_label THEN 1.0 ELSE 0.0 END)::DOUBLE AS acc, count(*)::DOUBLE AS n FROM src),
r AS (
  SELECT 'label' AS row_type, label, precision, recall, f1_score, s::DOUBLE AS support FROM m
  UNION ALL SELECT 'accuracy', 'accuracy', acc, acc, acc, acc FROM a
  UNION ALL SELECT 'macro avg', 'macro avg', avg(precision), avg(recall), avg(f1_score), (SELECT n FROM a) FROM m
  UNION ALL SELECT 'weighted avg', 'weighted avg', sum(precision * s) / sum(s), sum(recall * s) / sum(s), sum(f1_score * s) / sum(s), (SELECT n FROM a) FROM m
)""") + """
SELECT row_type, label, round(precision, 10) AS precision, round(recall, 10) AS recall, round(f1_score, 10) AS f1_score,
  round(support, 10) AS support FROM r""")
def full_report_fixed_labels(spark, sf):
    return ev.full_report(fx.f2_predictions(spark, sf, "a"), decimals=D, labels=_FIXED)


@register("top_confused_pairs", O.with_(O.f2_cte("a"), O.metric_ctes()) + """
SELECT gold, pred, CAST(cnt AS BIGINT) AS count FROM pairs WHERE gold <> pred
ORDER BY cnt DESC, gold, pred LIMIT 20""")
def top_confused_pairs(spark, sf):
    return ev.top_confused_pairs(fx.f2_predictions(spark, sf, "a"), k=20)


@register("top_confused_pairs_by_model", O.with_(O.f2_stacked_cte(("a", "b", "c", "d")), O.metric_ctes(_BY)) + """
SELECT model_name, mode, gold, pred, count FROM (
  SELECT model_name, mode, gold, pred, CAST(cnt AS BIGINT) AS count,
    row_number() OVER (PARTITION BY model_name, mode ORDER BY cnt DESC, gold, pred) AS rk
  FROM pairs WHERE gold <> pred) WHERE rk <= 3""")
def top_confused_pairs_by_model(spark, sf):
    return ev.top_confused_pairs(fx.f2_stacked(spark, sf, ("a", "b", "c", "d")), k=3, by=_BY)


@register("lineitem_summary", O.with_(O.F5_CTE, O.metric_ctes()) + "\n" + O.summary_sql())
def lineitem_summary(spark, sf):
    return ev.summary_metrics(fx.f5_lineitem_pairs(spark, sf), decimals=D)


@register("lineitem_confusion_wide", O.with_(O.F5_CTE, O.metric_ctes()) + _wide_sql(("A", "N", "R")))
def lineitem_confusion_wide(spark, sf):
    return _columns(ev.confusion_wide(fx.f5_lineitem_pairs(spark, sf), ("A", "N", "R")), ("A", "N", "R"))


@register("lineitem_report", O.with_(O.F5_CTE, O.metric_ctes()) + "\n" + O.full_report_sql())
def lineitem_report(spark, sf):
    return ev.full_report(fx.f5_lineitem_pairs(spark, sf), decimals=D)


# Embeddings as logits over 64 classes, gold = the stored label (0-9).
_ARGMAX_SQL = """
src AS (
  SELECT vec_id, CAST(label AS VARCHAR) AS gold_label,
    CAST(list_position(embedding, list_max(embedding)) - 1 AS VARCHAR) AS predicted_label
  FROM embeddings
)"""


@register("argmax_decode", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS predicted_id,
  label AS gold_id FROM embeddings""")
def argmax_decode(spark, sf):
    e = fx.table(spark, sf, "embeddings")
    return e.select("vec_id", ev.argmax_decode("embedding").alias("predicted_id"), F.col("label").alias("gold_id"))


@register("argmax_metrics", O.with_(_ARGMAX_SQL, O.metric_ctes()) + "\n" + O.summary_sql())
def argmax_metrics(spark, sf):
    e = fx.table(spark, sf, "embeddings")
    rows = e.select(F.col("label").cast("string").alias("gold_label"),
                    ev.argmax_decode("embedding").cast("string").alias("predicted_label"))
    return ev.summary_metrics(rows, decimals=D)


@register("confusion_dense", O.with_(O.f2_cte("a"), O.metric_ctes()) + """
SELECT u.label AS gold,
  CAST(coalesce(sum(CASE WHEN p.pred = 'de' THEN p.cnt END), 0) AS BIGINT) AS de,
  CAST(coalesce(sum(CASE WHEN p.pred = 'en' THEN p.cnt END), 0) AS BIGINT) AS en,
  CAST(coalesce(sum(CASE WHEN p.pred = 'es' THEN p.cnt END), 0) AS BIGINT) AS es,
  CAST(coalesce(sum(CASE WHEN p.pred = 'fr' THEN p.cnt END), 0) AS BIGINT) AS fr
FROM (SELECT DISTINCT lang AS label FROM documents WHERE lang IS NOT NULL) u
LEFT JOIN pairs p ON p.gold = u.label
GROUP BY u.label""")
def confusion_dense(spark, sf):
    """Dense matrix over a given label list (the gold vocabulary); cells outside it are dropped."""
    from labelflow.operators import vocab as V

    labels = V.collect_labels(fx.table(spark, sf, "documents").select(F.col("lang").alias("label")))
    return _columns(ev.confusion_wide(fx.f2_predictions(spark, sf, "a"), labels), labels)


_LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@register("lineitem_flag_positions", f"""
SELECT l_returnflag, {", ".join(_LINE_ORDER)},
  CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY {", ".join(_LINE_ORDER)}) - 1 AS BIGINT) AS position
FROM lineitem""")
def lineitem_flag_positions(spark, sf):
    """A09-style positions inside a label that holds a third of all rows (each return flag).

    Exercises the skew-safe ordinal over the whole table; rows that tie on the
    ordering columns are identical in the output.
    """
    from labelflow.operators.sampling import group_ordinal

    li = fx.table(spark, sf, "lineitem").select("l_returnflag", *_LINE_ORDER)
    return group_ordinal(li, "l_returnflag", list(_LINE_ORDER))
