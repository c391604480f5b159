import numpy as np
import pytest

from labelflow.llm import langid as L
from labelflow.llm.common import held_out
from tests.llm.conftest import table

WORDS = {"en": "the of and to in that is was for with as by on are this", "fr": "le la les des une dans que pour avec est sur pas ce qui au",
         "de": "der die das und ist nicht ein eine mit auf von zu sich den dem"}


def text(lang, k):
    rng = np.random.default_rng([k, len(lang), ord(lang[0])])
    return " ".join(rng.choice(WORDS[lang].split(), 30))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(100 * a + k, text(lang, k), lang) for a, lang in enumerate(WORDS) for k in range(30)]
    return table(spark, [*rows, (900, None, "en"), (901, "sans étiquette", None), (None, text("fr", 77), "fr")])


@pytest.fixture(scope="module")
def model(labelled):
    return L.train(labelled, docs_per_language=25)


def test_awkward_rows(spark, docs, awkward, model):
    got = L.predict(docs, model).collect()
    assert len(got) == len(awkward) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    for i in (2, 3, 4, 11):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert all(r.lang_pred in WORDS for r in got if r.doc_id not in (2, 3, 4, 11))
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id in (1, 5)}) == 1


def test_words_and_backoff(model):
    assert model.predict("der die und") [0] == "de"
    assert "dasund" not in model.words and model.predict("dasund")[0] == "de"  # its n-grams are known
    assert model.predict("日本語") == (model.languages[model.prior], pytest.approx(1 / 3))
    assert set(WORDS["fr"].split()) & set(model.words) and model.predict("THE OF AND")[0] == "en"


def brute(model, body):
    """Word-first backoff, one word at a time."""
    total, seen = np.zeros(len(model.languages)), 0
    for w in L.words_of(body):
        if w in model.words:
            v = model.table[model.words[w]]
        else:
            v = next((np.mean([model.table[model.grams[g]] for g in L.grams(w, n) if g in model.grams], axis=0)
                      for n in range(L.LONGEST, 0, -1) if any(g in model.grams for g in L.grams(w, n))), None)
        if v is not None:
            total, seen = total + v, seen + 1
    p = np.exp((total - total.max()) * min(1, L.EVIDENCE_WORDS / seen))
    return model.languages[int(np.argmax(total))], p.max() / p.sum()


def test_same_as_brute_force(model):
    for k in range(40):
        mixed = " ".join(text(lang, 200 + k) for lang in list(WORDS)[k % 3:]) + " unbekannte wörter nouveaux " * (k % 4)
        want = brute(model, mixed)
        got = model.predict(mixed)
        assert got[0] == want[0] and got[1] == pytest.approx(want[1], rel=1e-4)


def test_nothing_to_learn_from(spark, docs, no_docs):
    model = L.train(no_docs)
    assert {(r.lang_pred, r.score) for r in L.predict(docs, model).collect()} == {("und", 0.0)}
    assert L.predict(no_docs, model).count() == 0


def test_selection_keeps_rows_as_they_are(spark, docs, model):
    kept = L.select_rows(docs, model, min_score=0.0)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "5", "5", "None", "6", "7", "8", "9", "10", "12"])


def test_query_on_held_out_documents(spark):
    from pyspark.sql import functions as F

    from labelflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = QUERIES["op1_langid"](spark, sf).join(docs.select("doc_id", "lang", held_out(F.col("doc_id"), 4, 2).alias("h")), "doc_id").collect()
    assert len(rows) == docs.count() and all(r.held_out == r.h for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in out) >= 0.95 * len(out)
