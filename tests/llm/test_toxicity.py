import numpy as np
import pytest

from labelflow.llm import toxicity as X
from tests.llm.conftest import prose, table

BAD = ["idiot", "trash", "scum"]


@pytest.fixture(scope="module")
def trained(spark):
    rows = [(k, prose(k, 40) + (" " + BAD[k % 3] + " " if k % 4 == 0 else " ") + prose(900 + k, 20)) for k in range(240)]
    labels = [(k, int(k % 4 == 0)) for k in range(240)] + [(3, None), (None, 1), (4, 0), (5000, 1)]
    docs = table(spark, rows)
    return docs, X.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_separates_unseen_texts(spark, trained):
    docs, model = trained
    new = [(k, prose(3000 + k, 50) + (f" {BAD[k % 3].upper()}!" if k % 2 else "")) for k in range(60)]
    got = {r.doc_id: r.score for r in X.score(table(spark, new), model).collect()}
    assert np.mean([(got[k] >= 0.5) == bool(k % 2) for k in got]) >= 0.95


def test_awkward_rows(spark, docs, awkward, trained):
    _, model = trained
    got = X.score(docs, model).collect()
    assert len(got) == len(awkward) and all(0 <= r.score <= 1 for r in got)
    base = 1 / (1 + np.exp(-model.intercept))
    assert all(r.score == pytest.approx(base) for r in got if r.doc_id in (2, 3, 4, 11))
    assert len({r.score for r in got if r.doc_id in (1, 5)}) == 1


def test_scores_are_the_linear_model_over_distinct_ngrams(spark, trained):
    import re

    import xxhash

    _, model = trained
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist(), strict=True))
    for text in ["Idiot idiot clown", "a", "été \U0001f600 x_y 12", prose(4, 300)]:
        found = {np.uint64(xxhash.xxh64_intdigest(f" {x} "[i:i + n].encode(), 1)).astype(np.int64).item() for x in re.findall(r"\w+", text.lower())
                 for n in (3, 4, 5) for i in range(len(x) + 3 - n)}
        got = X.score(table(spark, [(1, text)]), model).first().score
        assert got == pytest.approx(1 / (1 + np.exp(-(sum(weight.get(f, 0.0) for f in found) + model.intercept))))


def test_scores_keep_the_share_of_the_classes_when_the_sample_is_bounded(spark):
    rng = np.random.default_rng(3)
    labels = [(k, int(rng.random() < 0.1)) for k in range(900)]
    texts = [(k, " ".join(rng.choice(["red", "green", "blue", "grey"], 6)) + (" idiot" if toxic and k % 2 else "")) for k, toxic in labels]
    docs, marks = table(spark, texts), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    whole, bounded = ({r.doc_id: r.score for r in X.score(docs, X.train(docs, marks, docs_per_class=n, regularisation=0.01)).collect()} for n in (1000, 150))
    assert abs(np.mean(list(whole.values())) - 0.1) < 0.03
    assert abs(np.mean(list(bounded.values())) - np.mean(list(whole.values()))) < 0.03


def test_log_count_ratios():
    r = X.log_count_ratios(np.array([8.0, 0.0, 1.0]), np.array([0.0, 8.0, 1.0]), 10, 10)
    assert r[0] > 0 > r[1] and r[2] == 0


def test_one_class_or_none(spark, docs, no_docs):
    some = spark.createDataFrame([(1, 1), (6, 1)], "doc_id bigint, toxic int")
    assert {r.score > 0.99 for r in X.score(docs, X.train(docs, some)).collect()} == {True}
    model = X.train(no_docs, some)
    assert {r.score < 0.01 for r in X.score(docs, model).collect()} == {True}
    assert X.score(no_docs, model).count() == 0


def test_query_on_held_out_documents(spark):
    from labelflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op3_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    assert sum(r.predicted == r.toxic for r in out) >= 0.85 * len(out)
