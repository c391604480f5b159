import hashlib
import re
from collections import Counter

from labelflow.llm import pii
from tests.llm.conftest import table

# The base patterns in their plain form.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits))))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k in PLAIN for m in re.finditer(PLAIN[k], text or "") if passes(k, m[0])]


def spans(xs):
    return [(x["kind"], x["start"], x["end"]) for x in xs]


TEXTS = ["mail a.b+c@x-y.example.org, or a@b.c_d@e.f.g. x@y z@localhost @a.b a@b..c a@@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 0255.00.000.1 999999999999999999999.1.1.1 1.2.3",
         "4111 1111 1111 1111 4111-1111-1111-1112 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 41111111111111111111111111 12  34",
         "+1 (677) 555-7033, +1234567 +12345678 +1.2.3.4.5.6.7.8.9.0.1.2.3.4.5.6 ++49 30 1234567- +1( +", "é\U0001f600 a@b.c é +44 20 7946 0958 \U0001f600 10.0.0.1",
         "1.2.3.4 5105105105105100 +1 202 555 0143 q@r.st " * 30, "x" * 5000, "a@" * 3000, "9" * 4000, "1." * 3000, "+1" + " " * 3000, "a@b" + ".c" * 4000, "+1 2" * 900]


def test_base_spans_of_awkward_texts(spark, awkward):
    rows = [*awkward, *[(100 + k, t) for k, t in enumerate(TEXTS)]]
    got = pii.extract(table(spark, rows)).collect()
    assert Counter((r.doc_id, tuple(spans(r.base))) for r in got) == Counter((i, tuple(brute(t))) for i, t in rows)
    assert sum(len(r.base) for r in got) > 100


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(k, f"please call me at +1 202 555 {1000 + k} after noon, card no. 4111 1111 1111 1111 end") for k in range(12)]
    rows += [(50 + k, f"write to user{k}@mail.example.com for more") for k in range(8)]
    rows += [(100, "please call me at (202) 555-0199 after noon"), (101, "so write to jo [at] example.org for more"), (102, "the product is (202) 555-0100 metres long"),
             (103, "card no. 4111 1111 1111 1112 end"), (104, "no. 17 call me at 300.1.2.3 after"), (100, "please call me at (202) 555-0199 after noon")]
    got = pii.extract(table(spark, rows)).collect()
    added = Counter((r.doc_id, x["kind"], x["value"]) for r in got for x in r.added)
    assert added == Counter({(100, "phone", "(202) 555-0199"): 2, (101, "email", "jo [at] example.org"): 1})
    by = {r.doc_id: r for r in got}
    assert by[100].added[0]["start"] == 18 and by[103].base == [] and by[104].base == []


def test_candidates_do_not_depend_on_the_rest_of_the_text(spark):
    rows = [(k, f"please call me at +1 202 555 {1000 + k} after noon") for k in range(12)]
    rows += [(20 + k, f"now charge card number {c} today") for k, c in enumerate(("4111 1111 1111 1111", "5105 1051 0510 5100", "4012 8888 8888 1881", "5555 5555 5555 4444"))]
    rows += [(100, "please call me at (202) 555-0199 after noon, or else +44 20 7946 0958, 4111 1111 1111 1111"),
             (101, "now charge card number 3782 822463 10005 today"), (102, "now charge card number 4111 1111 1111 1112 today")]
    added = {(r.doc_id, x["kind"], x["value"]) for r in pii.extract(table(spark, rows)).collect() for x in r.added}
    assert added == {(100, "phone", "(202) 555-0199"), (101, "card", "3782 822463 10005")}


def test_rounds_go_on_until_patterns_settle(spark):
    rows = [(k, f"p0 q0 +1 202 555 {1000 + k} z") for k in range(5)]
    for step in range(6):  # each context is accepted through the candidates of the one before
        rows += [(100 * (step + 1) + k, f"p{side} q{side} (20{step}) 555-{1000 + k} z") for k in range(5) for side in (step, step + 1)]
    added = {x["value"] for r in pii.extract(table(spark, rows), min_confidence=0.3).collect() for x in r.added}
    assert added == {f"(20{step}) 555-{1000 + k}" for step in range(6) for k in range(5)}


def test_too_little_support_adds_nothing(spark):
    rows = [(1, "call me at +1 202 555 1000 now"), (2, "call me at (202) 555-0199 now")]
    assert all(r.added == [] for r in pii.extract(table(spark, rows)).collect())


def test_empty_table(no_docs):
    assert pii.extract(no_docs).count() == 0


def test_query(spark):
    from labelflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    df = QUERIES["op4_pii"](spark, sf)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for r in df.collect():
        want = brute(texts[r.doc_id])
        text = ",".join(f"{k}:{a}:{z}" for k, a, z in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in want) for k in PLAIN]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
