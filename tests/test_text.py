from pyspark.sql import functions as F

from labelflow.functions import text as T

SAMPLES = ["  a  b ", " x　y\u0085", "\x1cz\x1f", "line1\nline2", "a\r\nb", "a\x0bb", "", "   ",
           " p q", "tab\tsep", "Ünïcödé  text"]


def test_strip_normalize_match_python(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    got = df.select(T.py_strip("s"), T.normalize_ws("s"), T.match_normalize("s"), T.first_line("s"),
                    T.capitalize("s")).collect()
    for s, (a, b, c, d, e) in zip(SAMPLES, got):
        assert a == s.strip()
        assert b == " ".join(s.split())
        assert c == " ".join(s.strip().lower().split())
        assert d == (s.splitlines()[0] if s.splitlines() else "")
        assert e == s[:1].upper() + s[1:].lower()


def test_slug_and_flag(spark):
    df = spark.createDataFrame([("some-org/Chat-Model-3.2-1B-Instruct", " Yes "), ("plain.name", "0")], "n string, f string")
    got = df.select(T.name_slug("n"), T.mode_slug(F.lit("few-shot")), T.parse_flag("f")).collect()
    assert got[0][0] == "chat_model_3_2_1b_instruct" and got[0][1] == "few_shot" and got[0][2] is True
    assert got[1][0] == "plain_name" and got[1][2] is False
