"""Spark ML baseline: fixed label list, Unicode words, a sweep that does not depend on partitioning."""

import pytest
from pyspark.sql import functions as F

from labelflow.operators import ml

WORDS = {"fr": "été forêt garçon", "de": "größe straße übung", "en": "summer wood boy"}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, " ".join(WORDS[x].split()[k % 3:] + [f"n{i}"]), x) for i, (k, x) in enumerate((k, x) for k in range(20) for x in WORDS)]
    return spark.createDataFrame(data, "example_id bigint, utterance string, label string")


def test_words_of_any_script_stay_whole(spark):
    tok = ml.text_classifier().getStages()[1]
    out = tok.transform(spark.createDataFrame([("Été, straße_1 x² 日本!",)], "utterance string")).first()["tokens"]
    assert out == ["été", "straße_1", "x²", "日本"]


def test_labels_without_training_rows(rows):
    model = ml.text_classifier(max_iter=5, labels=["de", "en", "fr", "it"]).fit(rows.where("label <> 'en'"))
    scored = ml.predict_labels(model, rows.withColumn("label", F.when(F.col("label") == "en", "it").otherwise(F.col("label"))))
    assert scored.count() == rows.count() and {r[0] for r in scored.select("predicted_label").distinct().collect()} <= {"de", "en", "fr", "it"}


def test_sweep_is_the_same_for_any_partitioning(rows):
    one, _ = ml.sweep(rows.coalesce(1), (0.0, 0.1), max_iter=5)
    seven, model = ml.sweep(rows.repartition(7), (0.0, 0.1), max_iter=5)
    assert one.collect() == seven.collect()
    chosen = [r for r in one.collect() if r.chosen]
    assert len(chosen) == 1 and chosen[0].macro_f1 == max(r.macro_f1 for r in one.collect())
    assert chosen[0].n_train + chosen[0].n_validation == 60 and model.stages


def test_sweep_cuts_words_once_in_the_tasks_that_read(spark, rows):
    # each row is counted when its text is read for cutting words
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    once = rows.repartition(3).withColumn("utterance", counted.asNondeterministic()("utterance"))
    runs, model = ml.sweep(once, (0.0, 0.01, 0.1), max_iter=3)
    assert runs.count() == 3 and seen.value == rows.count()
    assert [type(x).__name__ for x in model.stages] == ["StringIndexerModel", "RegexTokenizer", "HashingTF", "IDFModel", "LogisticRegressionModel"]
    assert ml.predict_labels(model, rows).count() == rows.count()
