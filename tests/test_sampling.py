"""Ordinal, few-shot, split and rolling-window operators, including a dominant key."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from labelflow.operators import compare as C
from labelflow.operators import sampling as S


@pytest.fixture(scope="module")
def skewed(spark):
    # one label holds a third of the rows
    rows = [(i, "hot" if i % 3 == 0 else f"l{i % 17}", f"u{i}") for i in range(3000)]
    return spark.createDataFrame(rows, "example_id bigint, label string, utterance string")


def test_group_ordinal_equals_row_number(skewed):
    got = S.group_ordinal(skewed, "label", "example_id", bucket_rows=40)
    w = Window.partitionBy("label").orderBy("example_id")
    exp = skewed.withColumn("position", F.row_number().over(w) - 1)
    assert sorted(got.select("example_id", "position").collect()) == \
        sorted(exp.select("example_id", "position").collect())


def test_group_ordinal_shuffles_once_and_cuts_the_hot_group(skewed):
    plan = S.group_ordinal(skewed, "label", "example_id", bucket_rows=40)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "_bucket" in plan.split("Exchange hashpartitioning")[1][:60]
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("bucket_rows", [1, 7, 40, 900])
def test_group_ordinal_finds_buckets_in_compiled_code(skewed, bucket_rows):
    got = S.group_ordinal(skewed, "label", "example_id", bucket_rows=bucket_rows)
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    w = Window.partitionBy("label").orderBy("example_id")
    exp = skewed.withColumn("position", F.row_number().over(w) - 1)
    assert sorted(got.select("example_id", "position").collect()) == sorted(exp.select("example_id", "position").collect())


def test_group_ordinal_on_several_orders_ties_and_nulls(spark):
    rows = [(i % 5 or None, (i * 7) % 13 or None, f"k{i % 11}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, a int, b string, i int")
    got = S.group_ordinal(df, "g", ["a", "b", "i"], bucket_rows=7, total="n")
    w = Window.partitionBy("g")
    exp = df.withColumn("position", F.row_number().over(w.orderBy("a", "b", "i")) - 1).withColumn("n", F.count("*").over(w))
    assert sorted(map(str, got.collect())) == sorted(map(str, exp.collect()))
    chunked = S.group_ordinal(df.withColumn("all", F.lit(0)), "all", ["a", "b", "i"], bucket_rows=1).orderBy("position").collect()
    assert [r.position for r in chunked] == list(range(500))


def test_split_keeps_rows_without_a_label(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "example_id bigint, label string")
    assert {r.example_id: r.assigned for r in S.stratified_split(df).collect()} == {1: "train", 2: None, 3: "train"}


def test_few_shot_round_robin(spark):
    rows = [(1, "b", "u1"), (2, "a", "u2"), (3, "b", "u3"), (4, "a", "u4"), (5, "c", "u5"), (6, " ", "u6")]
    df = spark.createDataFrame(rows, "example_id bigint, label string, utterance string")
    got = [(r["label"], r["example_id"]) for r in S.few_shot_support(df, n=4).orderBy("round", "label").collect()]
    assert got == [("a", 2), ("b", 1), ("c", 5), ("a", 4)]


def test_few_shot_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select(F.col("id").alias("example_id"), (F.col("id") % 5).cast("string").alias("label"),
                                  F.lit("u").alias("utterance"))
    plan = S.few_shot_support(df, n=4)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "TakeOrderedAndProject" in plan


def test_stratified_split_proportions(skewed):
    out = S.stratified_split(skewed, test_size=0.1, seed=42, bucket_rows=40)
    counts = {r["label"]: (r["n"], r["v"]) for r in out.groupBy("label").agg(
        F.count("*").alias("n"), F.sum((F.col("assigned") == "validation").cast("int")).alias("v")).collect()}
    for n, v in counts.values():
        assert v == int(n * 0.1 + 0.5)


def test_rolling_mean_matches_window(spark):
    rows = [(r, s, None if s % 4 == 1 else float(s * (r + 1))) for r in range(3) for s in range(40)]
    rows += [(9, s, float(s)) for s in range(400)]  # one long run
    df = spark.createDataFrame(rows, "run int, t int, loss double")
    got = C.rolling_mean(df, "run", "t", "loss", window=5, bucket=16)
    w = Window.partitionBy("run").orderBy("t").rowsBetween(-4, 0)
    exp = df.where(F.col("loss").isNotNull()).withColumn("smoothed", F.avg("loss").over(w))
    a = sorted((r["run"], r["t"], round(r["smoothed"], 9)) for r in got.collect())
    b = sorted((r["run"], r["t"], round(r["smoothed"], 9)) for r in exp.collect())
    assert a == b


def test_early_stop_and_best(spark):
    rows = [("a", 1, 0.50), ("a", 2, 0.60), ("a", 3, 0.60), ("a", 4, 0.55), ("a", 5, 0.70),
            ("b", 1, 0.50), ("b", 2, 0.40), ("b", 3, 0.60)]
    df = spark.createDataFrame([(r, e, m, m) for r, e, m in rows],
                               "run string, epoch int, macro_f1 double, accuracy double")
    stop = {r["run"]: r["stop_epoch"] for r in C.early_stop_epoch(df).collect()}
    assert stop == {"a": 4, "b": None}
    best = {r["run"]: r["best_epoch"] for r in C.best_epoch(df).collect()}
    assert best == {"a": 5, "b": 3}


def test_group_ordinal_null_group_and_many_partitions(spark):
    rows = [(i, None if i % 4 == 0 else f"g{i % 3}") for i in range(200)]
    df = spark.createDataFrame(rows, "example_id bigint, label string")
    got = S.group_ordinal(df, "label", "example_id", bucket_rows=3)
    w = Window.partitionBy("label").orderBy("example_id")
    exp = df.withColumn("position", F.row_number().over(w) - 1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_label_ids_dense_in_code_point_order(spark):
    from labelflow.operators import vocab as V

    labels = [f"L{i:04d}" for i in range(1000)] + ["Z", "a", "É"]
    df = spark.createDataFrame([(x,) for x in labels * 2], "label string")
    got = sorted((r["label_id"], r["label"]) for r in V.label_ids(df).collect())
    assert [i for i, _ in got] == list(range(len(labels)))
    assert [x for _, x in got] == sorted(labels)


def _quotas(counts, share, total):
    """Largest remainders in exact fractions."""
    from fractions import Fraction
    from math import ceil, floor

    share = Fraction(str(share))
    n = sum(counts.values())
    wanted = floor(n * share + Fraction(1, 2)) if total == "round" else ceil(n * share)
    quota = {k: floor(v * share) for k, v in counts.items()}
    order = sorted(counts, key=lambda k: (-(counts[k] * share - quota[k]), -counts[k], k))
    for k in order[: wanted - sum(quota.values())]:
        quota[k] += 1
    return quota


@pytest.mark.parametrize("share, total", [(0.1, "round"), (0.1, "ceil"), (0.15, "round"), (0.333, "ceil"), (0.0, "round"), (1.0, "ceil")])
def test_apportion(spark, share, total):
    counts = {f"l{k}": (k * k) % 13 + 1 for k in range(40)} | {"big": 5000}
    got = S.apportion(spark.createDataFrame(list(counts.items()), "label string, n bigint"), share, total=total)
    assert {r["label"]: r["quota"] for r in got.collect()} == _quotas(counts, share, total)
    assert S.apportion(spark.createDataFrame([], "label string, n bigint"), share, total=total).count() == 0


def test_split_of_small_labels_has_the_size_asked_for(spark):
    rows = [(i, f"l{i % 60}") for i in range(180)] + [(1000 + i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "example_id int, label string")
    whole = S.stratified_split(df, quota="round", bucket_rows=20).groupBy("assigned").count().collect()
    assert {r["assigned"]: r["count"] for r in whole} == {"train": 162, "validation": 18, None: 5}
    alone = S.stratified_split(df).where("assigned = 'validation'").count()
    assert alone == 0  # three rows a label: a tenth of each rounds to none
