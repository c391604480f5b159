"""Registered source/sink round trips.

Each writes a table derived from the driver data into a fresh folder under the
session's checkpoint directory, reads it back through the source under test and
returns the result, so the twin is SQL over the original tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from labelflow.functions import extract as X
from labelflow.operators import compare as C
from labelflow.operators import evaluate as ev
from labelflow.operators import records as R
from labelflow.operators import vocab as V
from labelflow.plans import fixtures as fx
from labelflow.plans import oracle_sql as O
from labelflow.plans.chat_queries import _PREP_SQL, _records
from labelflow.plans.registry import register
from labelflow.plans.text_queries import _F3_VOCAB, _STRICT, _f3, _union_vocab, _UNION_SQL
from labelflow.session import scratch_dir
from labelflow.sources import blocks, io

D = 10


@register("jsonl_roundtrip", O.with_(_PREP_SQL) + "\nSELECT example_id, utterance, label, split FROM prep")
def jsonl_roundtrip(spark, sf):
    path = scratch_dir(spark, "records")
    io.write_jsonl(_records(spark, sf), path)
    io.require_keys(spark, path, ["messages", "meta"])
    return R.flatten_records(io.read_jsonl(spark, path, "example_id bigint, " + io.RECORD_SCHEMA))


# S06 for every table whose rows could pass as predictions: which of the columns a job reads are missing.
_CHECKED = {"labels": ("doc_id", "toxic"), "benchmark": ("item_id", "label"), "conversations": ("conv_id", "gold_label", "role")}


@register("required_columns", "SELECT * FROM (VALUES ('benchmark', 'label'), ('conversations', 'gold_label'), ('labels', '')) t(table_name, lacking)")
def required_columns(spark, sf):
    rows = []
    for name, wanted in _CHECKED.items():
        path = scratch_dir(spark, f"check_{name}")
        io.write_jsonl(fx.table(spark, sf, name), path)
        try:
            io.require_keys(spark, path, wanted)
            rows.append((name, ""))
        except ValueError:
            rows.append((name, ",".join(sorted(set(wanted) - io.json_keys(spark, path)))))
    return spark.createDataFrame(rows, "table_name string, lacking string")


@register("csv_multiline_roundtrip", O.with_(O.F3_CTE, _F3_VOCAB, f"""
ex AS (SELECT gold_label, {_STRICT} AS predicted_label FROM src, v)""", O.metric_ctes(src="ex")) + """
SELECT label, round(precision, 10) AS precision, round(recall, 10) AS recall, round(f1_score, 10) AS f1_score,
  support::DOUBLE AS support FROM scores""")
def csv_multiline_roundtrip(spark, sf):
    rows, labels = _f3(spark, sf)
    scored = rows.withColumn("predicted_label", X.extract_strict("raw_prediction", labels))
    path = scratch_dir(spark, "report")
    io.write_report_csv(ev.per_label_report(scored, decimals=D), path)
    back = io.read_csv(spark, path, io.REPORT_SCHEMA, empty_as_null=False)
    return back.withColumnRenamed("f1-score", "f1_score")


@register("label_metadata_roundtrip", O.with_(_UNION_SQL) + """
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id FROM u""")
def label_metadata_roundtrip(spark, sf):
    path = scratch_dir(spark, "label_meta")
    io.write_label_metadata(V.label_ids(_union_vocab(spark, sf)), path)
    return io.read_label_metadata(spark, path)


@register("metrics_json_10dp", O.with_(O.f2_cte("a"), O.metric_ctes()) + "\n" + O.summary_sql(d=10))
def metrics_json_10dp(spark, sf):
    path = scratch_dir(spark, "metrics")
    io.write_metrics_json(ev.summary_metrics(fx.f2_predictions(spark, sf, "a")), path, decimals=10)
    return spark.read.schema("accuracy double, macro_f1 double, n_rows bigint, n_labels bigint").json(path)


@register("split_csv_snapshot", O.with_(O.F1_CTE) + "\nSELECT example_id, text, label_text, split FROM src")
def split_csv_snapshot(spark, sf):
    path = scratch_dir(spark, "splits_csv")
    io.write_split_csv(fx.f1_raw_splits(spark, sf), path)
    return io.read_csv(spark, path, "example_id bigint, text string, label_text string, split string")


@register("split_union_scan", O.with_(_PREP_SQL) + """
SELECT example_id, utterance, label, split FROM prep""")
def split_union_scan(spark, sf):
    base = scratch_dir(spark, "split_files")
    recs = _records(spark, sf)
    for name in ("train", "val", "test"):
        io.write_jsonl(recs.where(F.col("meta.split") == name), f"{base}/{name}.jsonl")
    paths = {name: f"{base}/{name}.jsonl" for name in ("train", "val", "test", "extra")}  # there is no extra file
    rows = io.read_splits(spark, paths, "example_id bigint, " + io.RECORD_SCHEMA)
    return rows.select("example_id", "meta.utterance", "meta.label", "split")


_LOG_SQL = """
lg AS (
  SELECT event_type AS run, event_id, ts,
    CASE WHEN event_id % 6 = 0 THEN NULL ELSE value END AS train_mean_nll,
    (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id))::DOUBLE
      / count(*) OVER (PARTITION BY event_type) AS progress
  FROM events
)"""


@register("training_log_scan", O.with_(_LOG_SQL) + """
SELECT run, event_id, round(progress, 10) AS progress, train_mean_nll,
  round(avg(train_mean_nll) OVER (PARTITION BY run ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 10)
    AS smoothed
FROM lg WHERE train_mean_nll IS NOT NULL""")
def training_log_scan(spark, sf):
    """One log per event type, written in (ts, event_id) order; of two further runs one has no file and the
    other no progress (both skipped); rolling loss in file order."""
    from labelflow.operators.sampling import group_ordinal

    base = scratch_dir(spark, "run_logs")
    ev_ = fx.table(spark, sf, "events").select(
        F.col("event_type").alias("run"), "event_id", "ts",
        F.when((F.col("event_id") % 6) == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
         .alias("train_mean_nll"))
    logs = (group_ordinal(ev_, "run", ["ts", "event_id"], out="_pos", total="_n")
            .withColumn("progress", (F.col("_pos") + 1) / F.col("_n")))
    names = [r[0] for r in ev_.select("run").distinct().orderBy("run").collect()]
    for run in names:
        io.write_jsonl(logs.where(F.col("run") == run).orderBy("ts", "event_id")
                       .select("event_id", "ts", "train_mean_nll", "progress"), f"{base}/{run}")
    io.write_jsonl(ev_.select("event_id", "ts", "train_mean_nll"), f"{base}/bare")
    runs = {r: f"{base}/{r}" for r in (*names, "bare", "absent")}
    back = io.read_training_logs(spark, runs, schema="event_id bigint, progress double, train_mean_nll double")
    sm = C.rolling_mean(back, "run", list(io.ORDER_COLS), "train_mean_nll", window=5)
    return sm.select("run", "event_id", F.round("progress", D).alias("progress"), "train_mean_nll",
                     F.round("smoothed", D).alias("smoothed"))


@register("csv_blocks_roundtrip", "SELECT doc_id, text, lang, source FROM documents")
def csv_blocks_roundtrip(spark, sf):
    """Multi-line quoted texts, each file read by as many tasks as it has blocks."""
    path = scratch_dir(spark, "texts_csv")
    io.write_csv(fx.table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), path)
    return blocks.read_quoted_csv(spark, path, "doc_id bigint, text string, lang string, source string")


def _ordered_jsonl(spark, sf):
    path = scratch_dir(spark, "ordered_lines")
    io.write_jsonl(fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey"), path)
    return path


@register("line_ordinals", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS line FROM orders")
def line_ordinals(spark, sf):
    """Exact positions of lines in file order."""
    return io.read_jsonl_numbered(spark, _ordered_jsonl(spark, sf), "o_orderkey bigint").select("o_orderkey", "line")


@register("first_lines", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS line FROM orders QUALIFY line < 50")
def first_lines(spark, sf):
    """O03 on files: the first 50 lines, from the files they stand in."""
    return io.read_jsonl_numbered(spark, _ordered_jsonl(spark, sf), "o_orderkey bigint", first=50).select("o_orderkey", "line")


@register("confusion_wide_files", O.with_(O.f2_cte("a"), O.metric_ctes(), """
labels AS (SELECT gold AS label FROM pairs UNION SELECT pred FROM pairs)""") + """
SELECT 'gold,' || string_agg(label, ',' ORDER BY label) AS value FROM labels
UNION ALL
SELECT g.label || ',' || string_agg(CAST(coalesce(cnt, 0) AS VARCHAR), ',' ORDER BY p.label)
FROM labels g CROSS JOIN labels p LEFT JOIN pairs ON pairs.gold = g.label AND pairs.pred = p.label GROUP BY g.label""")
def confusion_wide_files(spark, sf):
    """A06 from sparse pairs and a table of labels: the header and a line per label."""
    pairs = ev.pair_counts(fx.f2_predictions(spark, sf, "a")).checkpoint(eager=True)
    ids = V.label_ids(pairs.select(F.explode(F.array(ev.GOLD, ev.PRED)).alias("label")))
    path = scratch_dir(spark, "confusion_lines")
    io.write_wide_pairs(pairs, ids.checkpoint(eager=True), path)
    return spark.read.text(path).select("value")
