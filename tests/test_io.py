"""Sources and sinks on hand-made files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from labelflow.session import scratch_dir
from labelflow.sources import io


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_jsonl_blank_lines_order_and_failfast(spark):
    base = scratch_dir(spark, "t-jsonl")
    _write(f"{base}/a/part-0.json", [json.dumps({"x": i, "s": f"é{i}"}) for i in range(5)] + ["", "   "])
    _write(f"{base}/a/part-1.json", [json.dumps({"x": 10 + i}) for i in range(3)])
    df = io.read_jsonl(spark, f"{base}/a", "x int, s string", with_order=True)
    assert [r["x"] for r in df.orderBy(*io.ORDER_COLS).collect()] == [0, 1, 2, 3, 4, 10, 11, 12]
    assert df.where(F.col("s") == "é3").count() == 1
    _write(f"{base}/b/part-0.json", ['{"x": 1}', "{not json"])
    with pytest.raises(Exception):
        io.read_jsonl(spark, f"{base}/b", "x int").collect()


def test_read_splits_skips_missing(spark):
    base = scratch_dir(spark, "t-splits")
    _write(f"{base}/train/p.json", ['{"text": "a", "label_text": "x"}'])
    _write(f"{base}/val/p.json", ['{"text": "b", "label_text": "y"}', '{"text": "c"}'])
    df = io.read_splits(spark, {"train": f"{base}/train", "validation": f"{base}/val",
                                "test": f"{base}/test"}, "text string, label_text string")
    got = sorted((r["split"], r["text"], r["label_text"]) for r in df.collect())
    assert got == [("train", "a", "x"), ("validation", "b", "y"), ("validation", "c", None)]
    with pytest.raises(FileNotFoundError):
        io.read_splits(spark, {"test": f"{base}/none"}, "text string")


def test_csv_roundtrip_quotes_newlines_commas(spark):
    base = scratch_dir(spark, "t-csv")
    rows = [("a,b", 1.0), ('say "hi"', 0.5), ("two\nlines", 0.25), ("", 0.0)]
    df = spark.createDataFrame(rows, "label string, precision double")
    io.write_csv(df, base, single_file=True)
    back = io.read_csv(spark, base, "label string, precision double", empty_as_null=False)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_metrics_json_rounding(spark):
    base = scratch_dir(spark, "t-metrics")
    df = spark.createDataFrame([(0.41777777777777775, 0.2095731158123, 7)], "accuracy double, macro_f1 double, n bigint")
    io.write_metrics_json(df, base, decimals=10)
    r = spark.read.json(base).first()
    assert r["accuracy"] == 0.4177777778 and r["macro_f1"] == 0.2095731158 and r["n"] == 7


def _wide_lines(path):
    import glob

    return {os.path.dirname(f).removeprefix(path).strip("/"): open(f, newline="").read() for f in sorted(glob.glob(f"{path}/**/part-*", recursive=True)) if not f.endswith(".crc")}


def test_wide_pairs_equal_the_given_list_form(spark):
    from labelflow.operators import evaluate as ev

    labels = sorted(["a", "A", "b.c", 'q"t', "two\nlines", "x,y", "", "zz"])
    rows = [(g, p) for i, g in enumerate(labels[:-1]) for p in labels[i::3] for _ in range(i + 1)]
    pairs = ev.pair_counts(spark.createDataFrame(rows, "gold_label string, predicted_label string"))
    one, two, three = (scratch_dir(spark, f"t-wide-{k}") for k in range(3))
    io.write_wide_confusion(ev.confusion_wide(None, labels, pairs=pairs), labels, one)
    ids = spark.createDataFrame([(x, i) for i, x in enumerate(labels)], "label string, label_id int")
    assert io.write_wide_pairs(pairs, ids, two) == 1
    assert io.write_wide_pairs(pairs, ids, three, cells_per_file=24) == 3
    (expected,), (whole,) = _wide_lines(one).values(), _wide_lines(two).values()
    assert whole == expected
    import csv
    import io as sio

    table, parts = list(csv.reader(sio.StringIO(expected))), _wide_lines(three)
    assert sorted(parts) == ["file=0", "file=1", "file=2"]
    read = [list(csv.reader(sio.StringIO(parts[f"file={k}"]))) for k in range(3)]
    assert all(r[0] == table[0] for r in read) and [x for r in read for x in r[1:]] == table[1:]


def test_wide_pairs_of_many_labels(spark):
    n = 3000
    ids = spark.range(n).select(F.format_string("l%05d", "id").alias("label"), F.col("id").cast("int").alias("label_id"))
    pairs = ids.select(F.col("label").alias("gold"), F.format_string("l%05d", (F.col("label_id") * 7) % n).alias("pred"), F.lit(5).cast("long").alias("count"))
    path = scratch_dir(spark, "t-wide-many")
    assert io.write_wide_pairs(pairs, ids, path, cells_per_file=1_000_000) == 10
    lines = [x.split(",") for k in range(10) for x in _wide_lines(path)[f"file={k}"].splitlines()[1:]]
    assert [x[0] for x in lines] == [f"l{k:05d}" for k in range(n)]
    assert all(len(x) == n + 1 and x[1 + (k * 7) % n] == "5" and x.count("0") == n - 1 for k, x in enumerate(lines))
