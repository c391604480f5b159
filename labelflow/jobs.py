"""Command-line jobs: the reference's scripts as Spark applications over files.

    python -m labelflow.jobs prepare   --train T --validation V --test X --out DIR [--include-oos false]
    python -m labelflow.jobs evaluate  --predictions P.jsonl --out DIR
    python -m labelflow.jobs confusion --predictions P.jsonl --out DIR [--top-k 20]
    python -m labelflow.jobs compare   --required NAME=metrics.json ... [--optional NAME=path ...] --out DIR
    python -m labelflow.jobs curves    --run NAME=metrics.jsonl ... --out DIR
    python -m labelflow.jobs score     --input test.jsonl --predictor module:factory --mode zero-shot --out DIR
    python -m labelflow.jobs baseline  --train train.jsonl --validation val.jsonl --test test.jsonl --out DIR

Every job reads and writes through Spark (folders of part files); result tables
that are a few rows are written as single files.
"""

from __future__ import annotations

import argparse
import importlib
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.functions import chat
from labelflow.functions.text import name_slug, parse_flag, py_strip
from labelflow.operators import compare as C
from labelflow.operators import evaluate as ev
from labelflow.operators import ml, records as R, sampling as S, score as SC, vocab as V
from labelflow.session import job_session, scratch_dir
from labelflow.sources import io

PRED_SCHEMA = "example_id bigint, " + io.PREDICTION_SCHEMA
RECORD_SCHEMA = "example_id bigint, " + io.RECORD_SCHEMA


def _read_table(spark: SparkSession, path: str, fmt: str | None) -> DataFrame:
    fmt = fmt or ("parquet" if path.endswith(".parquet") else "csv" if path.endswith(".csv") else "json")
    if fmt == "csv":
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return spark.read.format(fmt).load(path)


def _kv(items):
    out = {}
    for it in items or []:
        name, _, path = it.partition("=")
        out[name] = path
    return out


def _stem(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[: -len(".jsonl")] if base.endswith(".jsonl") else base


# --- jobs ----------------------------------------------------------------------------------

def prepare(a) -> None:
    """Raw splits -> chat records per split + label metadata."""
    spark = job_session()
    include_oos = spark.range(1).select(parse_flag(F.lit(a.include_oos))).first()[0]
    parts = []
    for split, path in (("train", a.train), ("validation", a.validation), ("test", a.test)):
        if path and io.path_exists(spark, path):
            df = _read_table(spark, path, a.format)
            key = F.col(a.id_col) if a.id_col in df.columns else F.lit(None)
            parts.append(df.select(key.cast("bigint").alias("example_id"), F.lit(split).alias("split"), F.lit(a.id_col in df.columns).alias("_has"),
                                   F.col(a.text_col).cast("string").alias("text"),
                                   F.col(a.label_col).cast("string").alias("label_text")))
    raw = parts[0]
    for p in parts[1:]:
        raw = raw.unionByName(p)
    lacking = [r[0] for r in raw.where(~F.col("_has")).select("split").distinct().collect()]
    if lacking:
        # ids made here differ between the splits, lie above those that are given, and are written: a later read must not make others
        most = raw.agg(F.coalesce(F.max("example_id"), F.lit(-1))).first()[0]
        numbered = scratch_dir(spark, "numbered")
        made = F.monotonically_increasing_id() + F.lit(max(0, most + 1))
        raw.withColumn("example_id", F.when(F.col("_has"), F.col("example_id")).otherwise(made)).write.parquet(numbered)
        raw = spark.read.parquet(numbered)
    raw = raw.drop("_has")
    vocab = V.vocab_from_split(raw, include_oos=include_oos)
    labels = V.collect_labels(vocab)
    io.write_label_metadata(V.label_ids(vocab), f"{a.out}/metadata/label_map")
    recs = R.prepare_records(raw, labels, include_oos=include_oos)
    for short in ("train", "val", "test"):
        io.write_jsonl(recs.where(F.col("meta.split") == short), f"{a.out}/processed/{short}.jsonl")
    for r in S.split_counts(R.flatten_records(recs)).collect():
        print(f"split {r['split']}: rows={r['n_rows']} labels={r['n_labels']} file={a.out}/processed/{r['split']}.jsonl")
    print(f"vocabulary: {len(labels)} labels, out-of-scope rows {'kept' if include_oos else 'dropped'}")


def _predictions(spark: SparkSession, path: str) -> DataFrame:
    """A predictions file that has gold and predicted labels; says how many rows no metric can use."""
    io.require_keys(spark, path, ["gold_label", "predicted_label"])
    preds = io.read_jsonl(spark, path, PRED_SCHEMA)
    lost = ev.unlabelled_rows(preds).first()
    if lost["n_unlabelled"]:
        print(f"{lost['n_unlabelled']} of {lost['n_rows']} rows have no gold label and are left out")
    return preds


def evaluate(a) -> None:
    """Predictions -> metrics JSON + per-label report CSV."""
    spark = job_session()
    preds = _predictions(spark, a.predictions)
    pairs = ev.pair_counts(preds).checkpoint(eager=True)
    stem = a.stem or _stem(a.predictions)
    metrics = ev.summary_metrics(None, pairs=pairs)
    io.write_metrics_json(metrics.select("accuracy", "macro_f1"), f"{a.out}/{stem}_metrics.json", decimals=10)
    io.write_report_csv(ev.per_label_report(None, pairs=pairs), f"{a.out}/{stem}_per_intent_report.csv")
    print(metrics.select("accuracy", "macro_f1").first().asDict())


def confusion(a) -> None:
    """Predictions -> wide confusion CSV over all labels seen + top-k pairs."""
    spark = job_session()
    preds = _predictions(spark, a.predictions)
    pairs = ev.pair_counts(preds).checkpoint(eager=True)
    stem = a.stem or _stem(a.predictions)
    seen = pairs.select(F.explode(F.array(ev.GOLD, ev.PRED)).alias("label")).distinct()
    ids = V.label_ids(seen).checkpoint(eager=True)  # made-up labels count too: the list stays a table
    io.write_wide_pairs(pairs, ids, f"{a.out}/{stem}_confusion.csv")
    top = ev.top_confused_pairs(None, k=a.top_k, pairs=pairs)
    io.write_csv(top, f"{a.out}/{stem}_top_confused_pairs.csv", single_file=True)
    for r in top.collect():
        print(r["gold"], r["pred"], r["count"])


def compare(a) -> None:
    """Metric files -> model comparison summary."""
    spark = job_session()
    required, optional = _kv(a.required), _kv(a.optional)
    parts = []
    for name, path in {**required, **optional}.items():
        if not io.path_exists(spark, path):
            if name in required:
                raise FileNotFoundError(f"required model {name}: {path} does not exist")
            print(f"optional model {name} left out, {path} does not exist")
            continue
        parts.append(io.read_metrics(spark, path).withColumn("model", F.lit(name)))
    metrics = parts[0]
    for p in parts[1:]:
        metrics = metrics.unionByName(p)
    out = C.model_comparison(metrics, required=list(required), optional=list(optional),
                             prefixed_first=a.prefixed or ())
    io.write_csv(out, f"{a.out}/model_comparison_summary.csv", single_file=True)
    for r in out.collect():
        print(r["model"], r["accuracy"], r["macro_f1"])


def curves(a) -> None:
    """Training logs -> smoothed loss over progress."""
    spark = job_session()
    logs = io.read_training_logs(spark, _kv(a.run))
    sm = C.rolling_mean(logs, "run", list(io.ORDER_COLS), "train_mean_nll", window=a.window)
    out = sm.select("run", "step", C.progress_percent("progress").alias("progress_pct"), "train_mean_nll",
                    "smoothed")
    io.write_csv(out, f"{a.out}/training_curves.csv")


def _load_factory(spec: str):
    mod, _, attr = spec.partition(":")
    return getattr(importlib.import_module(mod), attr)


def _prediction_stem(spark: SparkSession, model_name: str, mode: str) -> str:
    return spark.range(1).select(F.concat(name_slug(F.lit(model_name)), F.lit("_"), F.lit(mode.replace("-", "_")), F.lit("_predictions"))).first()[0]


def _wave_folder(spark: SparkSession, model_name: str, a) -> str:
    """Where finished waves are kept: one folder for each model, mode, input and strategy."""
    import hashlib

    what = hashlib.sha256("\0".join([a.input, a.train or "", a.strategy, str(a.max_few_shot)]).encode()).hexdigest()[:12]
    return f"{_prediction_stem(spark, model_name, a.mode)}.{what}.progress"


def score(a) -> None:
    """Records -> prompts -> predictor -> extracted labels -> predictions + metrics."""
    spark = job_session()
    rows = io.read_jsonl(spark, a.input, RECORD_SCHEMA, with_order=True)
    train = io.read_jsonl(spark, a.train, RECORD_SCHEMA, with_order=True) if a.mode == "few-shot" else None
    gold = py_strip(F.coalesce(F.col("meta.label"), F.lit("")))
    flat = rows.select("example_id", *io.ORDER_COLS, chat.utterance_from_record("messages", F.col("meta.utterance"))
                       .alias("utterance"), gold.alias("gold_label"))
    sources = [(flat, "gold_label")]
    if train is not None:
        sources.append((train.select(F.col("meta.label").alias("label")), "label"))
    labels = V.collect_labels(V.vocab_union(*sources))
    if a.limit is not None:                       # vocabulary uses every row, the limit only the scoring
        flat = flat.orderBy(*io.ORDER_COLS).limit(a.limit)
    if a.mode == "few-shot":
        tr = train.select(F.struct(*io.ORDER_COLS).alias("example_id"),
                          chat.utterance_from_record("messages", F.col("meta.utterance")).alias("utterance"),
                       F.col("meta.label").alias("label"))
        support = S.collect_support(S.few_shot_support(tr, n=a.max_few_shot), n=a.max_few_shot)
        msgs = chat.few_shot_messages("utterance", labels, support)
    else:
        msgs = chat.zero_shot_messages("utterance", labels)
    prompts = flat.withColumn("prompt", chat.render_upper(msgs))
    model_name = a.model_name or a.predictor
    if a.waves > 1:  # results are kept wave by wave; run the same command again after a failure
        progress = f"{a.out}/{_wave_folder(spark, model_name, a)}"
        scored = SC.score_in_waves(prompts, _load_factory(a.predictor), "prompt", progress, waves=a.waves, labels=labels, strategy=a.strategy, batch_size=a.batch_size)
    else:
        scored = SC.score(prompts, _load_factory(a.predictor), "prompt", labels, a.strategy, a.batch_size)
    recs = SC.prediction_records(scored, mode=a.mode, model_name=model_name)
    stem = _prediction_stem(spark, model_name, a.mode)
    path = f"{a.out}/{stem}.jsonl"
    io.write_jsonl(recs, path)
    back = io.read_jsonl(spark, path, PRED_SCHEMA)
    pairs = ev.pair_counts(back).checkpoint(eager=True)
    io.write_metrics_json(ev.summary_metrics(None, pairs=pairs).select("accuracy", "macro_f1"),
                          f"{a.out}/{stem}_metrics.json", decimals=10)
    io.write_report_csv(ev.per_label_report(None, pairs=pairs), f"{a.out}/{stem}_per_intent.csv")


def baseline(a) -> None:
    """Spark ML text classifier: train, validate, test, report."""
    spark = job_session()

    def load(path):
        r = io.read_jsonl(spark, path, RECORD_SCHEMA)
        # the encoder reads the whole first user message
        u = chat.first_user_content("messages")
        return R.nonblank_rows(r, u, F.col("meta.label"), keep=("example_id",))

    train = load(a.train)
    if a.validation and io.path_exists(spark, a.validation):
        val = load(a.validation)
    else:
        split = S.stratified_split(train, label="label", key="example_id", test_size=0.1, seed=a.seed, quota="ceil")
        split = split.checkpoint(eager=True)
        val = split.where(F.col("assigned") == "validation").drop("assigned")
        train = split.where(F.col("assigned") == "train").drop("assigned")
    test = load(a.test)
    labels = V.collect_labels(V.vocab_union((train, "label"), (val, "label"), (test, "label"), strip=False))
    model = ml.text_classifier(max_iter=a.max_iter, reg_param=a.reg_param, labels=labels).fit(train)
    vp = ml.predict_labels(model, val)
    tp = ml.predict_labels(model, test).checkpoint(eager=True)
    vm = ev.summary_metrics(vp, gold="label").first()
    tm = ev.summary_metrics(tp, gold="label").first()
    metrics = spark.createDataFrame([(
        "spark-ml-tfidf-lr", len(labels), train.count(), val.count(), test.count(),
        float(vm["accuracy"]), float(vm["macro_f1"]), float(tm["accuracy"]), float(tm["macro_f1"]))],
        "model_name string, num_labels int, train_examples bigint, validation_examples bigint, "
        "test_examples bigint, validation_accuracy double, validation_macro_f1 double, test_accuracy double, "
        "test_macro_f1 double")
    io.write_metrics_json(metrics, f"{a.out}/metrics.json", decimals=None)
    io.write_csv(ev.full_report(tp, gold="label", labels=labels), f"{a.out}/per_intent_report.csv", single_file=True)
    io.write_jsonl(tp.select("example_id", "utterance", F.col("label").alias("gold_label"), "predicted_label",
                             F.lit("spark-ml-tfidf-lr").alias("model_name")), f"{a.out}/test_predictions.jsonl")
    print(metrics.first().asDict())


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="labelflow.jobs")
    sub = ap.add_subparsers(dest="job", required=True)

    p = sub.add_parser("prepare")
    p.add_argument("--train", required=True)
    p.add_argument("--validation")
    p.add_argument("--test")
    p.add_argument("--format")
    p.add_argument("--text-col", default="text")
    p.add_argument("--label-col", default="label_text")
    p.add_argument("--id-col", default="example_id")
    p.add_argument("--include-oos", default="false")
    p.add_argument("--out", required=True)
    p.set_defaults(fn=prepare)

    for name, fn in (("evaluate", evaluate), ("confusion", confusion)):
        p = sub.add_parser(name)
        p.add_argument("--predictions", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--stem")
        if name == "confusion":
            p.add_argument("--top-k", type=int, default=20)
        p.set_defaults(fn=fn)

    p = sub.add_parser("compare")
    p.add_argument("--required", nargs="*", default=[])
    p.add_argument("--optional", nargs="*", default=[])
    p.add_argument("--prefixed", nargs="*", default=[])
    p.add_argument("--out", required=True)
    p.set_defaults(fn=compare)

    p = sub.add_parser("curves")
    p.add_argument("--run", nargs="+", required=True)
    p.add_argument("--window", type=int, default=5)
    p.add_argument("--out", required=True)
    p.set_defaults(fn=curves)

    p = sub.add_parser("score")
    p.add_argument("--input", required=True)
    p.add_argument("--train")
    p.add_argument("--mode", choices=["zero-shot", "few-shot"], required=True)
    p.add_argument("--predictor", required=True, help="module:factory returning texts -> texts")
    p.add_argument("--model-name")
    p.add_argument("--strategy", default="strict")
    p.add_argument("--limit", type=int)
    p.add_argument("--max-few-shot", type=int, default=4)
    p.add_argument("--batch-size", type=int, default=64)
    p.add_argument("--waves", type=int, default=1, help="jobs to score in; finished ones are kept for a restart")
    p.add_argument("--out", required=True)
    p.set_defaults(fn=score)

    p = sub.add_parser("baseline")
    p.add_argument("--train", required=True)
    p.add_argument("--validation")
    p.add_argument("--test", required=True)
    p.add_argument("--max-iter", type=int, default=50)
    p.add_argument("--reg-param", type=float, default=0.0)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--out", required=True)
    p.set_defaults(fn=baseline)

    a = ap.parse_args(argv)
    a.fn(a)


if __name__ == "__main__":
    main(sys.argv[1:])
