"""Failure modes and small operators: required models, metric fallback, unknown labels, tokenizer."""

import pytest
from pyspark.sql import functions as F

from labelflow.operators import compare as C
from labelflow.operators import score as SC
from labelflow.operators import vocab as V

MSCHEMA = "model string, accuracy double, macro_f1 double, test_accuracy double, test_macro_f1 double"


def test_model_comparison_required_and_fallback(spark):
    m = spark.createDataFrame([("enc", None, None, 0.9, 0.8), ("zs", 0.2, 0.1, None, None),
                               ("opt", 0.5, 0.4, None, None)], MSCHEMA)
    out = {r["model"]: (r["accuracy"], r["macro_f1"]) for r in
           C.model_comparison(m, required=["enc", "zs"], optional=["opt", "gone"], prefixed_first=["enc"]).collect()}
    assert out == {"enc": (0.9, 0.8), "zs": (0.2, 0.1), "opt": (0.5, 0.4)}
    with pytest.raises(ValueError, match="absent"):
        C.model_comparison(m, required=["enc", "absent"])
    empty = spark.createDataFrame([("x", None, None, None, None)], MSCHEMA)
    with pytest.raises(Exception, match="neither"):
        empty.select(C.get_metric("accuracy", "test_accuracy")).collect()
    assert empty.select(C.get_metric("accuracy", "test_accuracy", "default")).first()[0] == 0.0
    missing = [r["model"] for r in C.missing_models(m, ["enc", "gone"]).collect()]
    assert missing == ["gone"]


def test_encode_unknown_label_raises(spark):
    ids = V.label_ids(spark.createDataFrame([("a",), ("b",)], "label string"))
    ok = V.encode_labels(spark.createDataFrame([("b",), ("a",)], "label string"), ids)
    assert sorted(map(tuple, ok.collect())) == [("a", 0), ("b", 1)]
    bad = V.encode_labels(spark.createDataFrame([("c",)], "label string"), ids)
    with pytest.raises(Exception, match="unknown label"):
        bad.collect()
    assert V.encode_labels(spark.createDataFrame([("c",)], "label string"), ids, on_unknown="null").first()[1] is None
    dec = V.decode_labels(spark.createDataFrame([(1,)], "label_id int"), ids)
    assert dec.first()["label"] == "b"


def test_token_budget(spark):
    df = spark.createDataFrame([("a b  c\nd",), ("",), ("one",), ("\tfoo bar\n",), ("\u3000x\x1c",)], "t string")
    got = df.select(SC.token_count("t"), SC.truncate_tokens("t", 2)).collect()
    assert [tuple(r) for r in got] == [(4, "a b"), (0, ""), (1, "one"), (2, "foo bar"), (1, "x")]


def test_pluggable_tokenizer_truncates(spark):
    df = spark.createDataFrame([("abcd",), ("",), (None,), ("x",)], "t string")
    cut = [r[0] for r in df.select(SC.tokenizer_udf(lambda s: [ord(c) for c in s], max_tokens=3)("t")).collect()]
    assert cut == [[97, 98, 99], [], [], [120]]
    whole = [r[0] for r in df.select(F.size(SC.tokenizer_udf(lambda s: [ord(c) for c in s])("t"))).collect()]
    assert whole == [4, 0, 0, 1]


def test_skewed_labels_join_the_same_by_broadcast_and_by_salt(spark, monkeypatch):
    ids = V.label_ids(spark.createDataFrame([(f"l{i}",) for i in range(20)], "label string"))
    facts = spark.createDataFrame([(i, "l1" if i % 3 else f"l{i % 25}") for i in range(600)], "i int, label string")
    near = sorted(map(tuple, V.encode_labels(facts, ids, on_unknown="null").select("i", "label", "label_id").collect()), key=str)
    monkeypatch.setattr(V, "BROADCAST_ROWS", 3)
    far = V.encode_labels(facts, ids, on_unknown="null").select("i", "label", "label_id")
    assert sorted(map(tuple, far.collect()), key=str) == near
    assert sorted(map(tuple, V.decode_labels(far.drop("label"), ids).select("i", "label", "label_id").collect()), key=str) == [
        t if t[2] is not None else (t[0], None, None) for t in near]
