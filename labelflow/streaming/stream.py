"""Structured Streaming forms of scoring and evaluation.

The same column functions as the batch path run on a stream: extraction is a
stateless projection, the running confusion table is a streaming aggregation
(state = one row per (gold, pred) pair) or the sum of each batch's own counts, and prediction records go to a
checkpointed file sink in append mode (exactly-once per micro-batch).
Checkpoint locations live under the session's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelflow.functions.extract import extract_label
from labelflow.operators.evaluate import COUNT, GOLD, PRED
from labelflow.session import scratch_dir


def read_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def extract_stream(stream: DataFrame, labels: Sequence[str], text: str = "raw_prediction",
                   strategy: str = "cascade", out: str = "predicted_label") -> DataFrame:
    """Canonical labels on a stream (T01): a stateless projection."""
    return stream.withColumn(out, extract_label(F.col(text), labels, strategy))


def confusion_stream(stream: DataFrame, gold: str = "gold_label", pred: str = "predicted_label") -> DataFrame:
    """Running (gold, pred, count) over a stream (T02); metrics derive from it as in batch."""
    return (stream.where(F.col(gold).isNotNull())
            .select(F.col(gold).alias(GOLD), F.coalesce(F.col(pred), F.lit("")).alias(PRED))
            .groupBy(GOLD, PRED).agg(F.count(F.lit(1)).alias(COUNT)))


def append_to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                    available_now: bool = True) -> StreamingQuery:
    """Checkpointed append-only file sink of prediction records."""
    w = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start(path)


def _filesystem(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _finished(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the folders ``kind-<number>`` under ``path`` whose write has been committed."""
    fs, at = _filesystem(spark, path)
    if not fs.exists(at):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(at)]
    found = [int(n[len(kind) + 1:]) for n in names if n.startswith(f"{kind}-") and n[len(kind) + 1:].isdigit()]
    return sorted(k for k in found if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}-{k}/_SUCCESS")))


class PairCounts:
    """(gold, pred, count) of a stream, kept as each batch's own counts under ``path``.

    A batch writes one folder named by its number, committed as a whole; if it comes again after a
    restart, the folder is there and nothing is added. Readers add up committed folders, so they
    never see half a batch. Every ``merge_every`` batches the folders are summed into one; those a
    sum before the last replaces are deleted, so a reader that has listed them still finds them.
    """

    def __init__(self, spark: SparkSession, path: str, merge_every: int = 50):
        self.spark, self.path, self.merge_every = spark, path, merge_every

    def add(self, batch: DataFrame, number: int) -> None:
        """``foreachBatch`` function: the counts of one batch of rows (gold, pred)."""
        if number in _finished(self.spark, self.path, "batch") or number <= max(_finished(self.spark, self.path, "upto"), default=-1):
            return
        counts = batch.groupBy(GOLD, PRED).agg(F.count(F.lit(1)).alias(COUNT))
        counts.write.mode("overwrite").parquet(f"{self.path}/batch-{number}")
        if (number + 1) % self.merge_every == 0:
            self.merge()

    def merge(self) -> None:
        sums, batches = _finished(self.spark, self.path, "upto"), _finished(self.spark, self.path, "batch")
        last = max(batches, default=-1)
        if last <= max(sums, default=-1):
            return
        self.read().write.mode("overwrite").parquet(f"{self.path}/upto-{last}")
        if sums:  # what the last sum replaced is no longer listed by anyone who starts now
            fs, _ = _filesystem(self.spark, self.path)
            old = [f"batch-{k}" for k in batches if k <= sums[-1]] + [f"upto-{k}" for k in sums[:-1]]
            for name in old:
                fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)

    def read(self) -> DataFrame:
        """The counts of all committed batches; an empty table before the first."""
        last = max(_finished(self.spark, self.path, "upto"), default=-1)
        folders = [f"upto-{last}"] * (last >= 0) + [f"batch-{k}" for k in _finished(self.spark, self.path, "batch") if k > last]
        schema = f"{GOLD} string, {PRED} string, {COUNT} bigint"
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/{x}" for x in folders])
        return rows.groupBy(GOLD, PRED).agg(F.sum(COUNT).alias(COUNT))

    def follow(self, stream: DataFrame, checkpoint: str, gold: str = "gold_label", pred: str = "predicted_label") -> StreamingQuery:
        """Counts what is there of a stream, batch by batch, from where ``checkpoint`` stands."""
        rows = stream.where(F.col(gold).isNotNull()).select(F.col(gold).alias(GOLD), F.coalesce(F.col(pred), F.lit("")).alias(PRED))
        return (rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.add).trigger(availableNow=True).start())


_STOP_STATE = "best double, streak int, seen int, stopped boolean"


def early_stop_stream(epochs: DataFrame, patience: int = 2, run: str = "run", epoch: str = "epoch", metric: str = "macro_f1") -> DataFrame:
    """(run, stop_epoch): for each run of a stream of evaluations, once, the first epoch at which ``metric`` has
    not improved on its best for ``patience`` evaluations in a row (A14).

    State per run: the best value, evaluations since then, the last epoch and whether it has
    stopped. Epochs of one batch are taken in order; an epoch that comes again or after a later
    one is left out. Runs that don't stop give no row; a null metric is no improvement.
    """
    kind = epochs.schema[run].dataType.simpleString()

    def stop(key, frames, state):
        best, streak, seen, stopped = state.get if state.exists else (float("-inf"), 0, -(2**31), False)
        rows = pd.concat(list(frames))
        found = None
        for e, value in sorted(zip(rows["epoch"].tolist(), rows["metric"].tolist()), key=lambda x: x[0]):
            if stopped or e <= seen:
                continue
            seen = e
            if value is not None and value > best:
                best, streak = float(value), 0
            else:
                streak += 1
            if streak >= patience:
                stopped, found = True, e
        state.update((best, streak, int(seen), stopped))
        if found is not None:
            yield pd.DataFrame({"run": [key[0]], "stop_epoch": [found]})

    rows = epochs.select(F.col(run).alias("run"), F.col(epoch).cast("int").alias("epoch"), F.col(metric).cast("double").alias("metric"))
    return rows.groupBy("run").applyInPandasWithState(stop, f"run {kind}, stop_epoch int", _STOP_STATE, "append", "NoTimeout")


def complete_to_table(agg: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Run an aggregation stream to completion (availableNow) and return its final result table.

    Each complete-mode result goes to a folder of its own under the checkpoint folder; the last
    committed one is the full state. A stream without rows gives an empty table.
    """
    out = scratch_dir(spark, f"{name}-table")
    ckpt = scratch_dir(spark, f"{name}-ckpt")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch-{number}")

    q = (agg.writeStream.outputMode("complete").option("checkpointLocation", ckpt)
         .foreachBatch(write).trigger(availableNow=True).start())
    q.awaitTermination()
    done = _finished(spark, out, "batch")
    return spark.read.schema(agg.schema).parquet(f"{out}/batch-{done[-1]}") if done else spark.createDataFrame([], agg.schema)
