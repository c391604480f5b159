"""Extraction strategies on hand-made rows, against written answers and the statements in pyref."""

import pytest
from pyspark.sql import functions as F

from labelflow.functions import extract as X
from tests import pyref

LABELS = ["book_flight", "flight_status", "balance", "oos", "Transfer", "pay_bill", "bill", "a.b"]

TEXTS = [
    "book_flight", "  BOOK_FLIGHT  ", '"balance"', "'balance'", "\"'balance'\"",
    "balance\nmore words", "label: pay_bill, sure", "the intent is flight_status.",
    "assistant\n\nbalance", "", "   ", "unknown", "transfer", "Transfer it",
    "pay_bill bill", "bill pay_bill", "x bill", "billing", "a.b here", "xa.b",
    "oos; balance", "balance ", "　balance\u0085", "\x1cbalance", "Balance:\nbook_flight",
    'He said "hi" there', "flight_status\r\nsecond", "  \n  ", "book_flight book_flight",
]

# What the cascades answer for each of TEXTS.
ANSWERS = [
    "book_flight", "book_flight", "balance", "balance", "balance",
    "balance", "pay_bill", "flight_status",
    "balance", "", "", "unknown", "Transfer", "Transfer",
    "pay_bill", "pay_bill", "bill", "billing", "a.b", "xa.b",
    "oos", "balance", "balance", "balance", "balance",
    'He said "hi" there', "flight_status", "", "book_flight",
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")


@pytest.mark.parametrize("strategy,oracle", [
    ("first_line", lambda t, labs: pyref.first_line(t)),
    ("canonical", pyref.canonical),
    ("strict", pyref.strict),
])
def test_strategy_matches_python(rows, strategy, oracle):
    got = dict(rows.select("i", X.extract_label("t", LABELS, strategy).alias("p")).collect())
    for i, t in enumerate(TEXTS):
        assert got[i] == oracle(t, LABELS), (strategy, repr(t))


def test_whole_word_longest_first(spark):
    df = spark.createDataFrame([("x pay_bill bill",), ("bill",), ("nothing",), ("a.b!",)], "t string")
    got = [r[0] for r in df.select(X.whole_word_label(F.col("t"), LABELS)).collect()]
    assert got == ["pay_bill", "bill", None, "a.b"]


def test_extraction_is_idempotent_on_labels(spark):
    df = spark.createDataFrame([(x,) for x in LABELS], "t string")
    for strategy in ("canonical", "strict", "cascade_plain", "cascade"):
        got = [r[0] for r in df.select(X.extract_label("t", LABELS, strategy)).collect()]
        assert got == LABELS, strategy


def test_null_text_stays_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    for strategy in X.STRATEGIES:
        assert df.select(X.extract_label("t", LABELS, strategy)).first()[0] is None


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        X.extract_label(F.col("t"), LABELS, "nope")


@pytest.mark.parametrize("strategy", ["cascade_plain", "cascade", "set"])
def test_cascades_give_the_written_answers(rows, strategy):
    column = X.extract_cascade("t", LABELS, quote_mode="set") if strategy == "set" else X.extract_label("t", LABELS, strategy)
    got = dict(rows.select("i", column.alias("p")).collect())
    assert [got[i] for i in range(len(TEXTS))] == ANSWERS


def test_stages_of_the_cascade_in_order(spark):
    """Whole text before chunks, chunks before words, first chunk before later ones, longest word, then the first line."""
    cases = {"bill, balance": "bill", "my balance, bill": "bill", "my bill and my balance": "balance", "say 'oos', please": "oos", "'x', \"bill\"": "bill",
             "pay bill": "bill", "no label\nhere": "no label", " Book_Flight;": "book_flight"}
    got = dict(spark.createDataFrame([(t,) for t in cases], "t string").select("t", X.extract_label("t", LABELS, "cascade")).collect())
    assert got == cases
