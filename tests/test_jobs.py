"""The command-line jobs end to end on files derived from sf0.001."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from labelflow import jobs
from labelflow.plans import fixtures as fx
from labelflow.session import scratch_dir
from tests.conftest import SF_SMALL


def _one_json(path):
    files = glob.glob(os.path.join(path, "part-*"))
    with open(files[0]) as f:
        return json.loads(f.readline())


@pytest.fixture(scope="module")
def workdir(spark):
    base = scratch_dir(spark, "jobs")
    raw = fx.f1_raw_splits(spark, SF_SMALL)
    for split in ("train", "validation", "test"):
        raw.where(F.col("split") == split).drop("split").write.parquet(f"{base}/raw/{split}.parquet")
    jobs.main(["prepare", "--train", f"{base}/raw/train.parquet", "--validation", f"{base}/raw/validation.parquet",
               "--test", f"{base}/raw/test.parquet", "--out", base])
    return base


def test_prepare_writes_splits(spark, workdir):
    train = spark.read.json(f"{workdir}/processed/train.jsonl")
    assert train.count() > 0 and set(train.columns) >= {"messages", "meta"}
    assert spark.read.json(f"{workdir}/processed/val.jsonl").select("meta.split").distinct().first()[0] == "val"
    labels = spark.read.json(f"{workdir}/metadata/label_map").orderBy("label_id").collect()
    assert [r["label_id"] for r in labels] == list(range(len(labels)))
    assert "oos" not in [r["label"] for r in labels]


def test_score_evaluate_confusion_compare(spark, workdir):
    out = f"{workdir}/results"
    for mode in ("zero-shot", "few-shot"):
        jobs.main(["score", "--input", f"{workdir}/processed/test.jsonl", "--train",
                   f"{workdir}/processed/train.jsonl", "--mode", mode, "--predictor",
                   "labelflow.plans.model_queries:keyword_model", "--model-name", "org/Keyword-Model-1.0",
                   "--strategy", "cascade", "--out", out])
    stem = "keyword_model_1_0_zero_shot_predictions"
    preds = f"{out}/{stem}.jsonl"
    assert spark.read.json(preds).count() == spark.read.json(f"{workdir}/processed/test.jsonl").count()
    m = _one_json(f"{out}/{stem}_metrics.json")
    assert 0.0 <= m["accuracy"] <= 1.0
    jobs.main(["evaluate", "--predictions", preds, "--out", f"{workdir}/tables"])
    assert _one_json(f"{workdir}/tables/{stem}_metrics.json") == m
    jobs.main(["confusion", "--predictions", preds, "--out", f"{workdir}/tables", "--top-k", "5"])
    assert glob.glob(f"{workdir}/tables/{stem}_top_confused_pairs.csv/part-*")
    jobs.main(["compare", "--required", f"zero={out}/{stem}_metrics.json",
               f"few={out}/keyword_model_1_0_few_shot_predictions_metrics.json",
               "--optional", f"missing={workdir}/nope.json", "--out", f"{workdir}/figures"])
    summary = spark.read.option("header", True).csv(f"{workdir}/figures/model_comparison_summary.csv")
    assert sorted(r["model"] for r in summary.collect()) == ["few", "zero"]


def test_baseline_and_curves(spark, workdir):
    jobs.main(["baseline", "--train", f"{workdir}/processed/train.jsonl", "--test",
               f"{workdir}/processed/test.jsonl", "--max-iter", "20", "--out", f"{workdir}/baseline"])
    m = _one_json(f"{workdir}/baseline/metrics.json")
    assert m["validation_examples"] > 0 and 0.0 <= m["test_macro_f1"] <= 1.0
    ev = fx.table(spark, SF_SMALL, "events").where(F.col("user_id") < 3)
    for u in (0, 1, 2):
        (ev.where(F.col("user_id") == u).orderBy("ts", "event_id")
         .select(F.col("value").alias("train_mean_nll"), (F.col("event_id") / 1000.0).alias("progress"))
         .write.json(f"{workdir}/runs/{u}"))
    jobs.main(["curves", "--run", *[f"r{u}={workdir}/runs/{u}" for u in (0, 1, 2)], f"r9={workdir}/runs/9",
               "--out", f"{workdir}/curves"])
    c = spark.read.option("header", True).csv(f"{workdir}/curves/training_curves.csv")
    assert sorted(r[0] for r in c.select("run").distinct().collect()) == ["r0", "r1", "r2"]


def _records(spark, path, rows):
    """Chat records from (example_id, user content, utterance, label)."""
    schema = "example_id bigint, messages array<struct<role:string,content:string>>, meta struct<utterance:string,label:string,split:string>"
    data = [(i, [("system", "s"), ("user", u), ("assistant", lab)], (utt, lab, "test")) for i, u, utt, lab in rows]
    spark.createDataFrame(data, schema).write.json(path)
    return path


def echo_model():
    """Answers with the last word of the prompt's last utterance."""
    import re

    return lambda texts: [re.findall(r'Utterance: "([^"]*)"', t)[-1].split()[-1] for t in texts]


def test_missing_column_raises(spark, tmp_path):
    spark.createDataFrame([("a", "b")], "gold_label string, other string").write.json(f"{tmp_path}/p.jsonl")
    for job in ("evaluate", "confusion"):
        with pytest.raises(ValueError, match="predicted_label"):
            jobs.main([job, "--predictions", f"{tmp_path}/p.jsonl", "--out", f"{tmp_path}/out"])


def test_score_strips_gold_keeps_ids_and_reads_the_utterance_from_messages(spark, tmp_path):
    test = _records(spark, f"{tmp_path}/test.jsonl", [(7, 'Utterance: "say en"', None, " en "), (9, 'Utterance: "say fr"', "now fr", "fr")])
    train = _records(spark, f"{tmp_path}/train.jsonl", [(1, 'Utterance: "eins de"', None, "de"), (2, 'Utterance: "one en"', None, "en")])
    jobs.main(["score", "--input", test, "--train", train, "--mode", "few-shot", "--predictor", "tests.test_jobs:echo_model",
               "--model-name", "echo", "--strategy", "cascade", "--out", f"{tmp_path}/out"])
    got = spark.read.json(f"{tmp_path}/out/echo_few_shot_predictions.jsonl").orderBy("example_id").collect()
    assert [(r.example_id, r.utterance, r.gold_label, r.predicted_label) for r in got] == [(7, "say en", "en", "en"), (9, "now fr", "fr", "fr")]
    assert _one_json(f"{tmp_path}/out/echo_few_shot_predictions_metrics.json")["accuracy"] == 1.0


def test_baseline_with_a_test_label_never_trained(spark, tmp_path):
    train = _records(spark, f"{tmp_path}/train.jsonl", [(i, f"{'ja' if i % 2 else 'yes'} w{i % 5}", None, "de" if i % 2 else "en") for i in range(40)])
    test = _records(spark, f"{tmp_path}/test.jsonl", [(1, "ja w1", None, "de"), (2, "oui w2", None, "fr")])
    jobs.main(["baseline", "--train", train, "--test", test, "--max-iter", "5", "--out", f"{tmp_path}/out"])
    m = _one_json(f"{tmp_path}/out/metrics.json")
    assert m["num_labels"] == 3 and m["test_examples"] == 2
    rows = spark.read.json(f"{tmp_path}/out/test_predictions.jsonl").collect()
    assert {r.utterance for r in rows} == {"ja w1", "oui w2"}


def test_confusion_of_odd_labels(spark, tmp_path):
    import csv

    odd = ["a", "A", "a.b", "gold", "`", 'q"q', "n\nn", "", "x,y"]
    spark.createDataFrame([(g, p) for g, p in zip(odd, odd[1:] + odd[:1])], "gold_label string, predicted_label string").coalesce(1).write.json(f"{tmp_path}/p.jsonl")
    jobs.main(["confusion", "--predictions", f"{tmp_path}/p.jsonl", "--out", f"{tmp_path}/out"])
    with open(glob.glob(f"{tmp_path}/out/p_confusion.csv/part-*")[0], newline="") as f:
        table = list(csv.reader(f))
    names = sorted(odd)
    assert table[0] == ["gold", *names] and [r[0] for r in table[1:]] == names
    cell = {(r[0], names[i]): int(x) for r in table[1:] for i, x in enumerate(r[1:])}
    assert all(cell[g, p] == int(odd[(odd.index(g) + 1) % len(odd)] == p) for g in odd for p in odd)


def test_job_session_keeps_the_launchers_settings(spark):
    from labelflow.session import job_session

    before = (spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"))
    s = job_session()
    assert (s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions")) == before
