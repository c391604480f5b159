"""Files read in blocks: quoted records and line numbers, whatever the block size."""

import os
import random

import pytest
from pyspark.sql import functions as F

from labelflow.session import scratch_dir
from labelflow.sources import blocks as B
from labelflow.sources import io

SCHEMA = "a string, b int, c string"


def field(rng):
    plain = ["x", "", "word", "two words", "é日", "0"]
    odd = ["line\nbreak", "a,b", 'say "hi"', "\n\n", '"', "\r\nx", ",", 'end"\n"', "many\n" * 40]
    return rng.choice(plain if rng.random() < 0.6 else odd)


def line(values):
    return ",".join('"' + v.replace('"', '""') + '"' if any(c in v for c in '",\n\r') else v for v in values)


def write(base, rng, sizes, end="\n"):
    os.makedirs(base, exist_ok=True)
    for k, n in enumerate(sizes):
        with open(f"{base}/part-{k:05d}.csv", "w", encoding="utf-8", newline="") as f:
            f.write("a,b,c" + end)
            f.write("".join(line([field(rng), str(i), field(rng)]) + end + ("" if rng.random() < 0.9 else end) for i in range(n)))


@pytest.fixture
def small_blocks(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(v)) for k, v in (("spark.sql.files.maxPartitionBytes", n), ("spark.sql.files.openCostInBytes", 0))]
    for k, v in kept.items():
        spark.conf.set(k, v)


def reference(spark, base, **kw):
    r = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    return sorted(map(repr, r.options(**kw).csv(base).collect()))


@pytest.mark.parametrize("block", [64, 1000, 20_000, 128 << 20])
def test_records_equal_one_task_a_file(spark, small_blocks, block):
    base = scratch_dir(spark, "t-quoted")
    write(base, random.Random(block), [300, 0, 1, 120])
    expected, other = reference(spark, base), reference(spark, base, nullValue="\0")
    small_blocks(block)
    df = B.read_quoted_csv(spark, base, SCHEMA)
    assert sorted(map(repr, df.collect())) == expected
    assert sorted(map(repr, B.read_quoted_csv(spark, base, SCHEMA, "\0").collect())) == other
    if block == 1000:
        assert df.rdd.getNumPartitions() > 8


def test_one_field_over_many_blocks(spark, small_blocks):
    base = scratch_dir(spark, "t-quoted-long")
    os.makedirs(base)
    with open(f"{base}/x.csv", "w", newline="") as f:
        f.write("a,b,c\n" + line(["long\n" * 5000, "1", "z"]) + "\n" + line(["p", "2", "q\n"]) + "\n")
    expected = reference(spark, base)
    small_blocks(2000)
    assert sorted(map(repr, B.read_quoted_csv(spark, base, SCHEMA).collect())) == expected


def test_large_files_take_this_way_and_give_the_same(spark, small_blocks):
    base = scratch_dir(spark, "t-quoted-io")
    write(base, random.Random(9), [400])
    expected = sorted(map(repr, io.read_csv(spark, base, SCHEMA, empty_as_null=False).collect()))
    small_blocks(3000)
    df = io.read_csv(spark, base, SCHEMA, empty_as_null=False)
    assert df.rdd.getNumPartitions() > 3 and sorted(map(repr, df.collect())) == expected


@pytest.mark.parametrize("block", [50, 700, 128 << 20])
def test_line_numbers_do_not_depend_on_blocks(spark, small_blocks, block):
    base = scratch_dir(spark, "t-lines")
    os.makedirs(base)
    rng, expected = random.Random(4), []
    for name in ("part-99999.json", "part-100000.json", "part-2.json"):
        with open(f"{base}/{name}", "w") as f:
            for i in range(200):
                text = f"{name} {i} " + "y" * rng.randint(0, 60)
                f.write(text + "\n" + "\n" * (rng.random() < 0.1) + "  \n" * (rng.random() < 0.1))
                expected.append((int(name[5:-5]), i, text))
    small_blocks(block)
    got = [r["value"] for r in B.numbered_lines(spark, base).orderBy("line").collect()]
    assert got == [t for *_, t in sorted(expected)]
    lines = [r["line"] for r in B.numbered_lines(spark, base).select("line").collect()]
    assert sorted(lines) == list(range(600))


def test_first_lines_open_a_prefix_of_the_files(spark):
    base = scratch_dir(spark, "t-first")
    os.makedirs(base)
    for k in range(12):
        with open(f"{base}/part-{k:05d}.json", "w") as f:
            f.write("".join(f"{k} {i}\n" for i in range(10)))
    df = B.first_lines(spark, base, 15)
    assert [r["value"] for r in df.orderBy("line").collect()] == [f"{k} {i}" for k in range(2) for i in range(10)][:15]
    assert len(df.inputFiles()) == 2
    assert B.first_lines(spark, base, 1000).count() == 120 and B.first_lines(spark, base, 0).count() == 0


def test_numbered_jsonl(spark):
    base = scratch_dir(spark, "t-numbered")
    io.write_jsonl(spark.range(50).select("id", F.lit("x").alias("s")).repartition(3), base)
    rows = io.read_jsonl_numbered(spark, base, "id bigint, s string")
    assert sorted(r["line"] for r in rows.collect()) == list(range(50)) and rows.columns == ["id", "s", "line"]
    assert [r["line"] for r in io.read_jsonl_numbered(spark, base, "id bigint", first=7).orderBy("line").collect()] == list(range(7))
