"""The join path gives the same labels as the inline path."""

import pytest
from pyspark.sql import functions as F

from labelflow.functions import extract as X
from tests.test_extract import LABELS, TEXTS


@pytest.mark.parametrize("strategy", ["canonical", "strict", "cascade_plain", "cascade"])
def test_join_equals_inline(spark, strategy):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(999, None)], "i int, t string")
    vocab = spark.createDataFrame([(x,) for x in LABELS], "label string")
    inline = dict(rows.select("i", X.extract_label("t", LABELS, strategy).alias("p")).collect())
    joined = dict(X.extract_label_join(rows, "i", "t", vocab, strategy).select("i", "predicted_label").collect())
    assert joined == inline


HARD = ["book flight", "c++", "@home", "++", "a.b", "été", "Ünï code", "-x-", "\\E", "balance", "x", ".", "r&b"]
HARD_TEXTS = ["please book flight now", "i like c++x", "c++ is", "x@home", "go @home", "a++b", "a ++ b", "say a.b.", "aa.bb", "un été chaud", "ünï code!", "q-x-q", "x\\Ey",
              "balance² now", "bal\u0303ance", "x\u203fbalance", "balance\u0301", "", None, "r&b", "xr&bx", "the . x", "x.x"]


@pytest.mark.parametrize("strategy", ["cascade_plain", "cascade"])
def test_join_equals_inline_on_labels_with_other_characters(spark, strategy):
    rows = spark.createDataFrame([(i, t, "carried") for i, t in enumerate(HARD_TEXTS)], "i int, t string, label string")
    vocab = spark.createDataFrame([(x,) for x in HARD], "label string")
    inline = dict(rows.select("i", X.extract_label("t", HARD, strategy).alias("p")).collect())
    out = X.extract_label_join(rows, "i", "t", vocab, strategy)
    assert out.columns == ["i", "t", "label", "predicted_label"]
    assert dict(out.select("i", "predicted_label").collect()) == inline


def test_many_accented_labels(spark):
    labels = [f"é{i}-ü" for i in range(1100)]
    rows = spark.createDataFrame([(1, "say é7-ü please"), (2, "é1099-ü"), (3, "none")], "i int, t string")
    got = X.extract_label_join(rows, "i", "t", spark.createDataFrame([(x,) for x in labels], "label string"), "cascade")
    assert dict(got.select("i", "predicted_label").collect()) == {1: "é7-ü", 2: "é1099-ü", 3: "none"}


def test_word_characters_are_those_of_python(spark):
    import re

    texts = ["balance² now", "bal\u0303ance", "balance", "x‿balance", "balance\u0301", "½balance", "_balance", "balance.", "١balance", "日balance"]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(X.whole_word_label(F.col("t"), ["balance"])).collect()]
    assert got == ["balance" if re.search(r"\bbalance\b", t) else None for t in texts]
