"""Scoring that is taken up again, counts of replayed batches, ids over splits."""

import os

import pytest
from pyspark.sql import functions as F

from labelflow import jobs
from labelflow.operators import evaluate as ev
from labelflow.operators import score as SC
from labelflow.session import scratch_dir
from labelflow.streaming import stream as st

LABELS = ["a", "b"]


def counting_model(folder, fails_on=None):
    """A predictor that leaves a line for each text it is called for, and may break down on one."""
    def make():
        def predict(texts):
            for t in texts:
                if t == fails_on:
                    raise RuntimeError("model lost")
            with open(f"{folder}/{os.getpid()}.calls", "a") as f:
                f.write("".join(t + "\n" for t in texts))
            return ["a" if t.endswith("0") else "b" for t in texts]
        return predict
    return make


def calls(folder):
    return sorted(x for n in os.listdir(folder) for x in open(f"{folder}/{n}").read().split())


def rows(spark, n):
    return spark.createDataFrame([(i, f"t{i}") for i in range(n)], "example_id bigint, utterance string")


def test_a_failed_job_goes_on_with_the_rest(spark, tmp_path):
    path, first, second = scratch_dir(spark, "t-waves"), tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    df = rows(spark, 60)
    of_wave = {r[0]: r[1] for r in df.select("utterance", F.pmod(F.xxhash64("example_id"), F.lit(6))).collect()}
    broken = next(t for t, w in of_wave.items() if w == 3)
    with pytest.raises(Exception, match="model lost"):
        SC.score_in_waves(df, counting_model(str(first), broken), "utterance", path, waves=6, labels=LABELS)
    kept = {t for t, w in of_wave.items() if w < 3}
    out = SC.score_in_waves(df, counting_model(str(second)), "utterance", path, waves=6, labels=LABELS)
    assert {r["utterance"]: r["predicted_label"] for r in out.collect()} == {f"t{i}": "a" if i % 10 == 0 else "b" for i in range(60)}
    assert out.count() == 60 and kept <= set(calls(first))
    assert calls(second) == sorted(set(of_wave) - kept)
    # nothing is left; rows that come later are scored alone
    again = tmp_path / "again"
    again.mkdir()
    more = SC.score_in_waves(rows(spark, 63), counting_model(str(again)), "utterance", path, waves=2, labels=LABELS)
    assert more.count() == 63 and calls(again) == ["t60", "t61", "t62"]


def test_half_written_waves_do_not_count(spark):
    path = scratch_dir(spark, "t-waves-half")
    df = rows(spark, 10)
    SC.score_in_waves(df, counting_model("/tmp"), "utterance", path, waves=2, most_waves=0, labels=LABELS)
    SC.score(df, counting_model("/tmp"), "utterance", LABELS).write.parquet(f"{path}/wave-lost")
    out = SC.score_in_waves(df, counting_model("/tmp"), "utterance", path, waves=2, labels=LABELS)
    assert out.count() == 10 and len({r["example_id"] for r in out.collect()}) == 10


def pairs(spark, n):
    return spark.createDataFrame([("g", f"p{i % 3}") for i in range(n)], f"{ev.GOLD} string, {ev.PRED} string")


def test_replayed_batches_count_once_and_merges_change_nothing(spark):
    counts = st.PairCounts(spark, scratch_dir(spark, "t-pairs"), merge_every=4)
    assert counts.read().count() == 0 and counts.read().columns == [ev.GOLD, ev.PRED, ev.COUNT]
    for number in range(13):
        counts.add(pairs(spark, 30), number)
        counts.add(pairs(spark, 30), number)
    counts.add(pairs(spark, 30), 2)
    assert {r[1]: r[2] for r in counts.read().collect()} == {"p0": 130, "p1": 130, "p2": 130}
    folders = os.listdir(counts.path.removeprefix("file:"))
    assert "upto-11" in folders and "batch-0" not in folders and len(folders) < 12


def test_a_write_that_was_cut_off_is_not_read(spark):
    counts = st.PairCounts(spark, scratch_dir(spark, "t-pairs-cut"))
    counts.add(pairs(spark, 30), 0)
    pairs(spark, 30).groupBy(ev.GOLD, ev.PRED).agg(F.count(F.lit(1)).alias(ev.COUNT)).write.parquet(f"{counts.path}/batch-1")
    os.remove(f"{counts.path.removeprefix('file:')}/batch-1/_SUCCESS")
    assert counts.read().agg(F.sum(ev.COUNT)).first()[0] == 30
    counts.add(pairs(spark, 30), 1)
    assert counts.read().agg(F.sum(ev.COUNT)).first()[0] == 60


def test_streams_without_rows_give_empty_tables(spark):
    src = scratch_dir(spark, "t-empty")
    os.makedirs(src)
    s = st.read_stream(spark, src, "gold_label string, predicted_label string")
    out = st.complete_to_table(st.confusion_stream(s), spark, "t-empty")
    assert out.count() == 0 and out.columns == [ev.GOLD, ev.PRED, ev.COUNT]
    counts = st.PairCounts(spark, scratch_dir(spark, "t-empty-pairs"))
    counts.follow(s, scratch_dir(spark, "t-empty-ckpt")).awaitTermination()
    assert counts.read().count() == 0


def test_following_a_stream_from_its_checkpoint(spark):
    src, ckpt = scratch_dir(spark, "t-follow"), scratch_dir(spark, "t-follow-ckpt")
    counts = st.PairCounts(spark, scratch_dir(spark, "t-follow-pairs"))
    for n in (5, 7):
        spark.createDataFrame([("g", "p")] * n + [(None, "p")], "gold_label string, predicted_label string").coalesce(1).write.mode("append").parquet(src)
        counts.follow(st.read_stream(spark, src, "gold_label string, predicted_label string"), ckpt).awaitTermination()
    assert [tuple(r) for r in counts.read().collect()] == [("g", "p", 12)]


def test_made_ids_differ_between_splits(spark):
    base = scratch_dir(spark, "t-ids")
    for split, n in (("train", 30), ("validation", 20), ("test", 10)):
        df = spark.range(n).select("id", F.concat(F.lit(f"{split} "), "id").alias("text"), F.lit("x").alias("label_text"))
        if split == "test":  # one split brings its ids
            df = df.withColumn("example_id", F.col("id") + 1000)
        df.write.parquet(f"{base}/{split}.parquet")
    jobs.main(["prepare", "--train", f"{base}/train.parquet", "--validation", f"{base}/validation.parquet", "--test", f"{base}/test.parquet", "--out", base])
    ids = [r[0] for s in ("train", "val", "test") for r in spark.read.json(f"{base}/processed/{s}.jsonl").select("example_id").collect()]
    assert len(ids) == 60 and len(set(ids)) == 60 and {1000, 1009} <= set(ids)


def test_token_counts_know_unicode_spaces(spark):
    texts = ["", "  ", "a  b c d\x1ce ", "　x", None, "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.orderBy("i").select(SC.token_count("t"), SC.truncate_tokens("t", 3), SC.truncate_tokens("t", 100), SC.token_count("t", ",")).collect()
    expected = [(len(t.split()), " ".join(t.split()[:3]), " ".join(t.split()), len([x for x in t.split(",") if x])) if t is not None else (None, None, None, None) for t in texts]
    assert [tuple(r) for r in got][:4] == expected[:4] and tuple(got[5]) == expected[5]
    assert got[4][1] is None
