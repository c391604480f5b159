"""Spark ML text-classification baseline and its macro-F1 model selection.

The encoder fine-tune of the reference is replaced by a distributed Spark ML
pipeline (tokenise, hash, IDF, multinomial logistic regression); training,
validation and test scoring all run as Spark jobs, and the same metric
operators score its predictions.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.operators.evaluate import summary_metrics
from labelflow.operators.sampling import stratified_split


# Rows of a training set that one task of a sweep holds.
FIT_ROWS = 20_000
# Runs of letters, digits and underscores of any script are words.
NON_WORD = r"[^\p{L}\p{N}_]+"


def text_classifier(text: str = "utterance", label: str = "label", num_features: int = 1 << 16,
                    max_iter: int = 50, reg_param: float = 0.0, labels: Sequence[str] | None = None) -> Pipeline:
    """Label ids (alphabetical) -> tokens -> TF-IDF -> logistic regression.

    ``labels`` fixes the label list, as the encoder run takes its ids from train,
    validation and test together; without it the ids are those of the training
    rows and an unknown label raises.
    """
    if labels is None:
        indexer = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc", handleInvalid="error")
    else:
        indexer = StringIndexerModel.from_labels(sorted(labels), inputCol=label, outputCol="label_idx", handleInvalid="error")
    tok = RegexTokenizer(inputCol=text, outputCol="tokens", pattern=NON_WORD, toLowercase=True)
    tf = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features)
    idf = IDF(inputCol="tf", outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol="label_idx", maxIter=max_iter, regParam=reg_param,
                            family="multinomial")
    return Pipeline(stages=[indexer, tok, tf, idf, lr])


def predict_labels(model: PipelineModel, df: DataFrame, out: str = "predicted_label") -> DataFrame:
    """Score with a fitted pipeline and decode class ids back to label strings."""
    labels = model.stages[0].labels
    scored = model.transform(df)
    dec = IndexToString(inputCol="prediction", outputCol=out, labels=labels)
    return dec.transform(scored)


def sweep(train: DataFrame, reg_params: Sequence[float], text: str = "utterance", label: str = "label",
          key: str = "example_id", validation_size: float = 0.2, seed: int = 42, max_iter: int = 50, parallelism: int = 4):
    """Grid over regularisation chosen on a validation split by macro-F1.

    Returns (metrics, model): a row per grid point (reg_param, accuracy, macro_f1,
    n_train, n_validation, chosen) and the model of the chosen run, the best
    macro-F1, on ties the smallest regularisation. The split is ``stratified_split``,
    which depends on the keys alone, so any partitioning gives the same runs.
    """
    rows = train.select(key, text, label).where(F.col(label).isNotNull())
    names = sorted(r[0] for r in rows.select(label).distinct().collect())
    indexer, tok, tf, idf, _ = text_classifier(text, label, labels=names).getStages()
    # words are cut and hashed once for all runs, in the tasks that read the rows: the number of those grows with the input
    hashed = tf.transform(tok.transform(rows)).select(key, label, "tf")
    parts = stratified_split(hashed, label, key, test_size=validation_size, seed=seed).persist()
    counts = {r["assigned"]: r["count"] for r in parts.groupBy("assigned").count().collect()}
    n_train, n_held = counts.get("train", 0), counts.get("validation", 0)
    weights = idf.fit(parts.where(F.col("assigned") == "train"))
    # training sums floating-point numbers in row order: the rows' hashes and number alone give one
    # order for every layout of the input, in as many parts as there are rows for
    buckets = max(1, -(-n_train // FIT_ROWS))
    fit_rows = parts.where(F.col("assigned") == "train").repartition(buckets, key).sortWithinPartitions(key)
    vectors = indexer.transform(weights.transform(fit_rows)).select("label_idx", "features").persist()
    held = weights.transform(parts.where(F.col("assigned") == "validation")).select(label, "features").persist()
    vectors.count()
    held.count()
    parts.unpersist()
    decode = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=names)

    def run(reg: float) -> tuple:
        lr = text_classifier(text, label, max_iter=max_iter, reg_param=reg, labels=names).getStages()[-1].fit(vectors)
        m = summary_metrics(decode.transform(lr.transform(held)), label, "predicted_label").first()
        model = PipelineModel(stages=[indexer, tok, tf, weights, lr])
        return float(reg), float(m["accuracy"] or 0.0), float(m["macro_f1"] or 0.0), model

    # runs share the cached vectors; their jobs are interleaved
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        runs = list(pool.map(inheritable_thread_target(train.sparkSession)(run), reg_params))
    vectors.unpersist()
    held.unpersist()
    best = max(range(len(runs)), key=lambda i: (runs[i][2], -runs[i][0]))
    table = [(reg, acc, f1, n_train, n_held, i == best) for i, (reg, acc, f1, _) in enumerate(runs)]
    out = train.sparkSession.createDataFrame(
        table, "reg_param double, accuracy double, macro_f1 double, n_train bigint, n_validation bigint, chosen boolean")
    return out, runs[best][3]
