from pyspark.sql import functions as F

from labelflow.functions import chat
from labelflow.operators import records as R


def test_user_prompt_and_record(spark):
    df = spark.createDataFrame([("  hi \"there\" ", "b")], "u string, l string")
    r = df.select(chat.chat_example("u", "l", F.lit("train"), ["z", "a"]).alias("r")).first()["r"]
    assert [m["role"] for m in r["messages"]] == ["system", "user", "assistant"]
    assert r["messages"][1]["content"] == 'Utterance: "hi "there""\nAllowed labels: a, z'
    assert r["messages"][0]["content"] == chat.SYSTEM_PROMPT
    assert r["meta"]["label"] == "b"


def test_conversation_renderers(spark):
    turns = [(1, 0, "system", "S"), (1, 1, "user", "U1"), (1, 2, "assistant", "A1"), (1, 3, "user", "U2"),
             (2, 0, "assistant", "A0"), (2, 1, "user", "U"), (3, 0, "user", 'x Utterance: "q1" "q2"')]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    conv = R.conversation_messages(df)
    got = {r["conv_id"]: r for r in conv.select(
        "conv_id", chat.flatten_until_assistant("messages").alias("p13"),
        chat.render_upper("messages").alias("p14"),
        F.size(chat.drop_assistant("messages")).alias("n"),
        chat.utterance_from_record("messages").alias("u")).collect()}
    assert got[1]["p13"] == "System: S\n\nUser: U1\n\nAssistant:"
    assert got[2]["p13"] == "Assistant:"
    assert got[1]["p14"] == "SYSTEM: S\n\nUSER: U1\n\nASSISTANT: A1\n\nUSER: U2\n\nASSISTANT:"
    assert got[1]["n"] == 3 and got[2]["n"] == 1
    assert got[3]["u"] == "q1" and got[1]["u"] == "U1"


def test_prepare_records_drops_nulls_and_oos(spark):
    rows = [(1, "train", " a  b ", "x"), (2, "validation", None, "x"), (3, "test", "t", None),
            (4, "train", "o", "oos"), (5, "validation", "v", "y")]
    df = spark.createDataFrame(rows, "example_id bigint, split string, text string, label_text string")
    out = R.flatten_records(R.prepare_records(df, ["x", "y"])).orderBy("example_id").collect()
    assert [(r["example_id"], r["utterance"], r["split"]) for r in out] == [(1, "a b", "train"), (5, "v", "val")]
    both = R.prepare_records(df, ["x", "y"], include_oos=True)
    assert both.count() == 3
