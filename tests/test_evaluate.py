"""Metric operators: Python oracle, properties and published-universe goldens."""

import random

import pytest
from pyspark.sql import functions as F

from labelflow.operators import evaluate as ev
from labelflow.plans import fixtures as fx
from tests import pyref
from tests.conftest import SF_MID


def _df(spark, gold, pred):
    return spark.createDataFrame(list(zip(gold, pred)), "gold_label string, predicted_label string")


def test_matches_python_oracle(spark):
    rnd = random.Random(7)
    labs = ["a", "b", "c", "d"]
    gold = [rnd.choice(labs) for _ in range(500)]
    pred = [g if rnd.random() < 0.6 else rnd.choice(labs + ["zz", "yy"]) for g in gold]
    df = _df(spark, gold, pred)
    acc, mf1, rep = pyref.metrics(gold, pred)
    s = ev.summary_metrics(df).first()
    assert s["accuracy"] == pytest.approx(acc) and s["macro_f1"] == pytest.approx(mf1)
    assert s["n_rows"] == 500 and s["n_labels"] == len(rep)
    for r in ev.per_label_report(df).collect():
        p, rc, f, sup = rep[r["label"]]
        assert (r["precision"], r["recall"], r["f1_score"]) == pytest.approx((p, rc, f))
        assert r["support"] == sup


def test_properties(spark):
    rnd = random.Random(3)
    gold = [rnd.choice("abcde") for _ in range(300)]
    pred = [g if rnd.random() < 0.7 else rnd.choice("abcdefg") for g in gold]
    df = _df(spark, gold, pred)
    rep = ev.per_label_report(df).collect()
    assert sum(r["support"] for r in rep) == 300
    acc = ev.summary_metrics(df).first()["accuracy"]
    weighted_recall = sum(r["recall"] * r["support"] for r in rep) / 300
    assert weighted_recall == pytest.approx(acc)
    full = {r["row_type"]: r for r in ev.full_report(df).collect() if r["row_type"] != "label"}
    assert full["accuracy"]["precision"] == pytest.approx(acc)
    assert full["weighted avg"]["recall"] == pytest.approx(acc)
    assert full["macro avg"]["support"] == 300.0
    names = ev.label_universe(ev.pair_counts(df))
    wide = ev.confusion_wide(df, names).collect()
    assert [r["gold"] for r in wide] == names
    assert sum(r["counts"][i] for i, r in enumerate(wide)) / 300 == pytest.approx(acc)
    sup = {r["label"]: r["support"] for r in rep}
    for r in wide:
        assert sum(r["counts"]) == sup[r["gold"]]


def test_sorted_report_and_topk(spark):
    df = _df(spark, ["a", "a", "b", "b", "c"], ["a", "b", "a", "b", "a"])
    labels = [r["label"] for r in ev.per_label_report(df).collect()]
    assert labels == ["b", "a", "c"]
    top = ev.top_confused_pairs(df, k=2).collect()
    assert [(r["gold"], r["pred"], r["count"]) for r in top] == [("a", "b", 1), ("b", "a", 1)]


def test_all_correct_topk_empty_keeps_schema(spark):
    df = _df(spark, ["a", "b"], ["a", "b"])
    top = ev.top_confused_pairs(df)
    assert top.count() == 0 and top.columns == ["gold", "pred", "count"]


def test_missing_columns_raise(spark):
    df = spark.createDataFrame([("a",)], "gold_label string")
    with pytest.raises(ValueError):
        ev.summary_metrics(df)


@pytest.mark.parametrize("n_gold,n_extra", [(150, 144), (150, 636)])
def test_hallucinated_labels_dilute_macro_f1(spark, n_gold, n_extra):
    """The published universes: 294 labels (144 never gold) and 786 labels (636 never gold)."""
    gold, pred = [], []
    for i in range(n_gold):
        for j in range(30):
            gold.append(f"g{i:03d}")
            pred.append(f"g{i:03d}" if j < 12 else f"h{(i * 30 + j) % n_extra:03d}")
    df = _df(spark, gold, pred)
    s = ev.summary_metrics(df).first()
    g = ev.summary_metrics(df, universe="gold").first()
    acc, mf1, rep = pyref.metrics(gold, pred)
    assert s["n_labels"] == n_gold + n_extra and g["n_labels"] == n_gold
    assert s["macro_f1"] == pytest.approx(mf1)
    assert g["macro_f1"] > s["macro_f1"]


def test_fixture_f2_published_numbers(spark):
    s = ev.summary_metrics(fx.f2_predictions(spark, SF_MID, "a")).first()
    assert round(s["accuracy"], 3) == 0.718 and round(s["macro_f1"], 5) == 0.61129 and s["n_labels"] == 5
    b = ev.summary_metrics(fx.f2_predictions(spark, SF_MID, "b")).first()
    assert round(b["accuracy"], 2) == 0.95


def test_grouped_metrics_equal_separate(spark):
    st = fx.f2_stacked(spark, SF_MID, ("a", "c"))
    by = {r["model_name"]: r for r in ev.summary_metrics(st, by="model_name").collect()}
    for g in ("a", "c"):
        one = ev.summary_metrics(fx.f2_predictions(spark, SF_MID, g)).first()
        assert by[f"guesser_{g}"]["macro_f1"] == pytest.approx(one["macro_f1"])


ODD = ["a", "A", "a.b", "gold", "`", 'q"q', "n\nn", "", "x,y", "é", " "]


def test_wide_confusion_of_any_labels(spark):
    gold, pred = ODD * 2, ODD + ODD[1:] + ODD[:1]
    wide = {r["gold"]: r["counts"] for r in ev.confusion_wide(_df(spark, gold, pred), ODD).collect()}
    assert wide == {g: [sum(1 for x, y in zip(gold, pred) if (x, y) == (g, p)) for p in ODD] for g in ODD}


def test_wide_confusion_of_many_labels(spark):
    names = [f"l{i:05d}" for i in range(5000)]
    df = _df(spark, names, names[1:] + names[:1])
    rows = ev.confusion_wide(df, names).where(F.col("gold").isin("l00000", "l04999")).collect()
    assert [r["counts"].index(1) for r in rows] == [1, 0] and all(len(r["counts"]) == 5000 for r in rows)


def test_unlabelled_rows_are_counted(spark):
    df = spark.createDataFrame([("a", "a"), (None, "a"), (None, None)], "gold_label string, predicted_label string")
    assert tuple(ev.unlabelled_rows(df).first()) == (2, 3)


def test_full_report_with_a_label_list(spark):
    df = _df(spark, ["a", "a", "b", "c"], ["a", "b", "b", "z"])
    rep = {r["label"]: r for r in ev.full_report(df, labels=["a", "b", "c", "never"]).collect()}
    assert "z" not in rep and rep["never"]["support"] == 0 and rep["never"]["f1_score"] == 0
    assert rep["macro avg"]["recall"] == pytest.approx((0.5 + 1 + 0 + 0) / 4) and rep["accuracy"]["precision"] == pytest.approx(0.5)
    by = ev.full_report(df.withColumn("m", F.lit(1)), by="m", labels=["a", "b", "c", "never"]).drop("m").collect()
    assert {r["label"]: tuple(r) for r in by} == {k: tuple(v) for k, v in rep.items()}


def test_argmax_first_index_on_ties(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],), ([2.0, 1.0, 2.0],), ([],), (None,)], "x array<float>")
    got = [r[0] for r in df.select(ev.argmax_decode("x")).collect()]
    assert got == [1, 0, None, None]
    lab = [r[0] for r in df.select(ev.argmax_decode("x", ["a", "b", "c"])).collect()]
    assert lab == ["b", "a", None, None]
