"""Stream = batch for the running confusion table."""

from labelflow.functions import extract as X
from labelflow.operators import evaluate as ev
from labelflow.plans import fixtures as fx
from labelflow.session import scratch_dir
from labelflow.streaming import stream as st
from tests.conftest import SF_SMALL


def test_stream_confusion_equals_batch(spark):
    rows = fx.f3_raw_outputs(spark, SF_SMALL)
    labels = sorted(r[0] for r in fx.table(spark, SF_SMALL, "documents").select("source").distinct().collect())
    src = scratch_dir(spark, "t-stream")
    rows.repartition(4).write.parquet(src)
    s = st.read_stream(spark, src, "example_id bigint, gold_label string, raw_prediction string",
                       max_files_per_trigger=1)
    streamed = st.complete_to_table(st.confusion_stream(st.extract_stream(s, labels)), spark, "t")
    batch = ev.pair_counts(rows.withColumn("predicted_label", X.extract_cascade("raw_prediction", labels)))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_early_stop_is_told_once_and_equals_batch(spark):
    """Runs that stop, recover too late, never stop, and have nulls; a restart between batches and a repeated epoch."""
    import itertools

    from pyspark.sql import functions as F

    from labelflow.operators import compare as C

    curves = {"a": [0.1, 0.3, 0.2, 0.2, 0.9], "b": [0.5, 0.5, 0.6, 0.5, 0.4], "c": [0.1, 0.2, 0.3, 0.4, 0.5], "d": [0.4, 0.3], "e": [0.2, 0.1, 0.3, 0.2, 0.25]}
    rows = [(r, e + 1, v) for r, values in curves.items() for e, v in enumerate(values)]
    df = spark.createDataFrame(rows, "run string, epoch int, macro_f1 double")
    batch = {r["run"]: r["stop_epoch"] for r in C.early_stop_epoch(df, patience=2).collect()}
    src, out, ckpt = (scratch_dir(spark, f"t-stop-{x}") for x in ("in", "out", "ckpt"))
    for some in ([1], [2], [2, 3], [4, 5]):  # epoch 2 comes twice
        df.where(F.col("epoch").isin(some)).coalesce(1).write.mode("append").parquet(src)
        s = st.read_stream(spark, src, "run string, epoch int, macro_f1 double", max_files_per_trigger=1)
        st.append_to_files(st.early_stop_stream(s), out, ckpt).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == sorted((r, e) for r, e in batch.items() if e is not None) and len(got) == len({r for r, _ in got})
    assert any(batch.values()) and not all(itertools.chain(batch.values()))
