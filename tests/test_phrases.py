"""Labels of several words: against one pattern per label, with a large vocabulary, and the plan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from labelflow.functions import extract as X

ALPHABET = ["ab", "b", "c2", "é", "日本", "_", " ", "  ", "-", "+", ".", "\n", "'", "\\E", "$"]


def per_label(text, labels):
    """The rule stated label by label: longest first, between word boundaries."""
    for x in sorted(set(labels), key=lambda x: (-len(x), x)):
        low = x.lower()
        if low and re.search(rf"\b{re.escape(low)}\b", text):
            return x
    return None


def made(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, most))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_rule_for_each_label(spark, seed):
    labels = [x for x in made(seed, 60, 6) if x.strip()] + ["Ab ab", "B-C2"]
    texts = made(100 + seed, 300, 14) + ["", "ab ab", "x ab ab.", "b-c2"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = dict(df.select("i", X.whole_word_label(F.col("t"), labels)).collect())
    assert got == {i: per_label(t, labels) for i, t in enumerate(texts)}


@pytest.mark.parametrize("most_bytes", [32 << 20, 6000, 0])
def test_join_equals_inline(spark, monkeypatch, most_bytes):
    monkeypatch.setattr(X, "BROADCAST_BYTES", most_bytes)
    labels = [x for x in made(7, 80, 6) if x.strip()]
    rows = spark.createDataFrame(list(enumerate([*made(8, 200, 14), "", None])), "i int, t string")
    vocab = spark.createDataFrame([(x,) for x in labels], "label string")
    for strategy in ("cascade_plain", "cascade"):
        inline = dict(rows.select("i", X.extract_label("t", labels, strategy)).collect())
        assert dict(X.extract_label_join(rows, "i", "t", vocab, strategy).select("i", "predicted_label").collect()) == inline


def test_no_labels(spark):
    df = spark.createDataFrame([("a b",), (None,)], "t string")
    assert [r[0] for r in df.select(X.whole_word_label(F.col("t"), ["", ""])).collect()] == [None, None]


def test_fifty_thousand_labels_in_one_pass(spark):
    """Two- and three-word labels in a table; every text holds a short and a long one."""
    vocab = spark.range(50_000).select(F.concat(F.lit("topic "), "id", F.when(F.col("id") % 2 == 0, F.concat(F.lit(" part "), F.col("id") % 7)).otherwise("")).alias("label"))
    rows = spark.range(2_000).select("id", F.concat(F.lit("please see topic "), F.col("id") * 20 + 1, F.lit(", or topic "), F.col("id") * 20, F.lit(" part "), (F.col("id") * 20) % 7,
                                                    F.lit(" and "), F.repeat(F.lit("more text "), 50)).alias("t"))
    out = X.extract_label_join(rows, "id", "t", vocab, "cascade")
    wrong = out.where(F.col("predicted_label") != F.concat(F.lit("topic "), F.col("id") * 20, F.lit(" part "), (F.col("id") * 20) % 7))
    assert out.count() == 2_000 and wrong.count() == 0


def test_text_moves_once_and_no_pattern_is_built_from_a_label(spark):
    """What is shuffled for a phrase is the phrase: the text is in the row's own entry only."""
    text = "alpha beta gamma " * 200
    rows = spark.createDataFrame([(i, text) for i in range(50)], "i int, t string")
    vocab = spark.createDataFrame([("beta gamma",), ("zeta",)], "label string")
    out = X.extract_label_join(rows, "i", "t", vocab, "cascade")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE(_text" not in plan and "_text" not in plan
    assert {r[0] for r in out.select("predicted_label").collect()} == {"beta gamma"}
