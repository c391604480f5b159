"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is a character n-gram of a lower-cased word with its boundaries, present or not; in
training it is known by a 64-bit hash. N-grams whose document frequencies differ between the classes beyond chance
(chi-square of at least ``SIGNIFICANT``) are features; should more pass than ``n_features``, a bound on
the size of the model, those that tell the classes apart best. Each is scaled by the log ratio of its smoothed frequencies
in the two classes, and Spark ML's logistic regression is fitted on the scaled features.

Training reads a sample of about ``docs_per_class`` labelled rows of each class, chosen by a
hash of the id; that and the number of features are the only bounds. A sampled row stands for as
many labelled rows of its class as were there for each one chosen, in the choice of features and in
the fit, so scores follow the classes' shares in all labelled rows. Every whole text is scored.

A null or empty text has no features and scores the intercept. Rows of ``labels`` with a null
label are ignored; a document labelled twice is toxic if either says so. With only one class,
or none, to learn from, the score is that class's (0 without any label). Repeated rows are
scored one by one; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.llm.common import field, id_text, materialise, parts
from labelflow.llm.langid import sample_per_group
from labelflow.session import scratch_dir

SIZES = (3, 4, 5)
_WORDS = re.compile(r"\w+")
_CACHE = 200_000
#: A feature's chi-square is at least this: 0.1 % of features that tell nothing pass.
SIGNIFICANT = 10.83


def grams(word: str) -> set[str]:
    """A word's distinct character n-grams."""
    padded = f" {word} "
    return {padded[i:i + n] for n in SIZES for i in range(len(padded) - n + 1)}


def gram_hashes(word: str) -> np.ndarray:
    """Hashes of a word's distinct character n-grams, ascending."""
    found = grams(word)
    return np.sort(np.fromiter(map(gram_hash, found), dtype=np.uint64, count=len(found)).view(np.int64))


def gram_hash(gram: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(gram.encode("utf-8", "surrogatepass"), 1)


class _Remembered(dict):
    """Word to ``make(word)``; when full, words that weren't used since the last time are forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word: str) -> np.ndarray:
        if len(self) >= _CACHE:
            self.old = dict(self)
            self.clear()
        out = self.old.get(word)
        out = self[word] = self.make(word) if out is None else out
        return out


def _words(text: str | None) -> set[str]:
    return set(_WORDS.findall(text.lower())) if text else set()


def distinct_over_words(text: str | None, of_word: _Remembered) -> np.ndarray:
    """Distinct values over the words of a text, ascending."""
    arrays = [a for w in _words(text) if len(a := of_word[w])]
    return np.unique(np.concatenate(arrays)) if arrays else np.empty(0, dtype=np.int64)


class Model:
    """Sorted n-gram hashes, their weights and an intercept; and the n-grams themselves with their places."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, intercept: float, places: dict[str, int] | None = None):
        self.hashes, self.weights, self.intercept, self.places = hashes, weights, intercept, places or {}

    def positions(self, word: str) -> np.ndarray:
        place = self.places.get
        found = [k for g in grams(word) if (k := place(g)) is not None]
        return np.array(found, dtype=np.int32)

    def scores(self, texts: list[str | None], of_word: _Remembered) -> np.ndarray:
        z = np.full(len(texts), self.intercept)
        mark = np.zeros(len(self.weights))
        for i, text in enumerate(texts):
            arrays = [of_word[w] for w in _words(text)]
            if arrays:
                there = np.concatenate(arrays)
                mark[there] = 1.0
                z[i] += mark @ self.weights
                mark[there] = 0.0
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _known(hashes: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Positions in ``hashes`` of those of ``some`` that are there."""
    if not len(hashes):
        return np.empty(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(hashes, some), len(hashes) - 1)
    return at[hashes[at] == some]


def log_count_ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, alpha: float = 1.0) -> np.ndarray:
    """Of the smoothed shares of the documents of each class that have a feature."""
    return np.log((toxic + alpha) / (n_toxic + 2 * alpha)) - np.log((clean + alpha) / (n_clean + 2 * alpha))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          docs_per_class: int = 3000, n_features: int = 1 << 15, min_docs: int = 3, regularisation: float = 1e-4, iterations: int = 60) -> Model:
    """Learns from the documents in ``labels``, which holds only rows that may be learned from."""
    spark = docs.sparkSession
    marks = materialise(labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label"))
                        .where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label")), "toxicity-labels")
    chosen = materialise(sample_per_group(marks, "label", F.col("id").cast("string"), docs_per_class), "toxicity-sample")
    there, taken = ({r[0]: r[1] for r in x.groupBy("label").count().collect()} for x in (marks, chosen))
    weight = {label: there[label] / n for label, n in taken.items()}
    rows = id_text(docs, id_col, text_col).join(chosen, "id").select("label", "text")

    def extract(batches):
        of_word = _Remembered(gram_hashes)
        for label, text in parts(batches):
            grams = [distinct_over_words(t, of_word) for t in text]
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(grams, pa.list_(pa.int64()))], ["label", "grams"])

    found = materialise(rows.mapInArrow(extract, "label int, grams array<bigint>"), "toxicity-grams")
    n = {int(k): v for k, v in found.groupBy("label").count().collect()}
    none = np.empty(0, dtype=np.int64)
    if len(n) < 2:
        return Model(none, np.empty(0), 30.0 if 1 in n else -30.0)
    n1, n0 = n[1], n[0]
    t, c = F.col("toxic"), F.col("clean")
    all1, all0 = n1 * weight[1], n0 * weight[0]
    wt, wc = t * weight[1], c * weight[0]
    apart = (wt * F.lit(all0) - wc * F.lit(all1)) ** 2 / ((wt + wc) * (all1 + all0 - wt - wc + 1))  # chi-square but for a constant
    all_ = n1 + n0
    significant = (t * n0 - c * n1) ** 2 * all_ >= SIGNIFICANT * (t + c) * (all_ - t - c) * n1 * n0
    best = (found.select(F.explode("grams").alias("gram"), "label").groupBy("gram")
            .agg(F.sum("label").cast("double").alias("toxic"), F.sum(1 - F.col("label")).cast("double").alias("clean"))
            .where((t + c >= min_docs) & significant).orderBy(F.desc(apart), "gram").limit(n_features).toArrow())
    order = np.argsort(best.column("gram").to_numpy())
    hashes, toxic, clean = (best.column(x).to_numpy()[order] for x in ("gram", "toxic", "clean"))
    ratio = log_count_ratios(toxic, clean, n1, n0)
    if not len(hashes):
        return Model(none, np.empty(0), float(np.log(all1 / all0)))
    shared = spark.sparkContext.broadcast((hashes, ratio))

    # the stored form of an ML vector, read back as one
    vector = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"
    stored = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])

    def scale(batches):
        known, r = shared.value
        for label, grams in parts(batches):
            at = [_known(known, np.array(g, dtype=np.int64)) for g in grams]
            out = [{"type": 0, "size": len(known), "indices": a.astype(np.int32), "values": r[a]} for a in at]
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.float64()), pa.array(out, stored)], ["label", "features"]).append_column(
                "weight", pa.array([weight[x] for x in label], pa.float64()))

    path = scratch_dir(spark, "toxicity-vectors")
    found.mapInArrow(scale, f"label double, features {vector}, weight double").write.parquet(path)
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT()), T.StructField("weight", T.DoubleType())])
    fit = LogisticRegression(regParam=regularisation, maxIter=iterations, standardization=False, weightCol="weight").fit(spark.read.schema(schema).parquet(path))

    def spell(batches):
        known = set(shared.value[0].tolist())
        seen = set()
        for (texts,) in parts(batches):
            new = {w for t in texts for w in _words(t)} - seen
            seen = (seen | new) if len(seen) < _CACHE else new
            named = {g: np.uint64(gram_hash(g)).astype(np.int64).item() for w in new for g in grams(w)}
            kept = [(g, h) for g, h in named.items() if h in known]
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in kept], pa.string()), pa.array([h for _, h in kept], pa.int64())], ["gram", "hash"])

    # of equal hashes, should there be any, one n-gram: at most as many rows as features
    spelled = rows.select("text").mapInArrow(spell, "gram string, hash bigint").groupBy("hash").agg(F.min("gram").alias("gram")).toArrow()
    places = dict(zip(spelled.column("gram").to_pylist(), np.searchsorted(hashes, spelled.column("hash").to_numpy()).tolist(), strict=True))
    return Model(hashes, fit.coefficients.toArray() * ratio, float(fit.intercept), places)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score (probability of the toxic class) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = id_text(docs, id_col, text_col)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(rows.schema["id"].dataType)

    def run(batches):
        m = shared.value
        of_word = _Remembered(m.positions)
        for ids, texts in parts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, key_type), pa.array(m.scores(texts, of_word), pa.float64())], ["id", "score"])

    return rows.mapInArrow(run, f"{field('id', rows, 'id')}, score double").withColumnRenamed("id", id_col)
