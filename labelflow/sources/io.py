"""File sources and sinks.

JSONL, CSV and JSON metric files are read and written by Spark's own file
sources, so they split and parallelise like any table. Where the reference
relies on file order (first N rows, k-th example, loss curves), ``read_jsonl``
can attach a line-order key built from the file path, the split offset and the
row id inside the split: ordering by it reproduces file order exactly without
numbering rows on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from labelflow.operators.evaluate import require_columns  # noqa: F401  (S06, re-exported)
from labelflow.sources import blocks

# Part number, path, split offset and row: the order of lines in a folder written by Spark.
ORDER_COLS = ("_part", "_file", "_block", "_row")

# Schemas of the reference's record shapes.
MESSAGE_SCHEMA = "struct<role:string,content:string>"
RECORD_SCHEMA = (f"messages array<{MESSAGE_SCHEMA}>, "
                 "meta struct<utterance:string,label:string,split:string>")
PREDICTION_SCHEMA = ("utterance string, gold_label string, predicted_label string, raw_prediction string, "
                     "mode string, model_name string")
METRICS_SCHEMA = ("accuracy double, macro_f1 double, test_accuracy double, test_macro_f1 double, "
                  "validation_accuracy double, validation_macro_f1 double")
LOG_SCHEMA = "progress double, train_mean_nll double"
REPORT_SCHEMA = "label string, precision double, recall double, `f1-score` double, support double"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop filesystem of the path (works for HDFS/S3/local)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: str | StructType | DataType,
               with_order: bool = False, fail_fast: bool = True) -> DataFrame:
    """JSON-lines scan; blank lines skipped, a malformed line fails the job.

    ``with_order=True`` adds ``_part, _file, _block, _row``: sorting by them is file
    order (part files by number: as text, part-100000 would come before part-99999).
    """
    mode = "FAILFAST" if fail_fast else "PERMISSIVE"
    if not with_order:
        return spark.read.schema(schema).option("mode", mode).json(path)
    lines = spark.read.text(path).select(
        "value", blocks.part_number(F.col("_metadata.file_path")).alias("_part"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"))
    lines = lines.where(F.length(F.regexp_replace("value", r"(?U)[\s\x1c-\x1f]", "")) > 0)
    parsed = lines.select(F.from_json("value", schema, {"mode": mode}).alias("r"), *ORDER_COLS)
    return parsed.select("r.*", *ORDER_COLS)


def read_jsonl_numbered(spark: SparkSession, path: str, schema: str | StructType | DataType, first: int | None = None, fail_fast: bool = True) -> DataFrame:
    """JSON-lines scan with ``line``: exact positions in file order, from 0, blank lines not counted.

    ``first`` keeps that many lines and opens only the files they stand in (O03).
    """
    lines = blocks.numbered_lines(spark, path) if first is None else blocks.first_lines(spark, path, first)
    mode = "FAILFAST" if fail_fast else "PERMISSIVE"
    return lines.select(F.from_json("value", schema, {"mode": mode}).alias("r"), "line").select("r.*", "line")


def json_keys(spark: SparkSession, path: str | Sequence[str]) -> set[str]:
    """Top-level keys that any row of a JSON-lines file has. Rows only send on the keys, each once per task."""
    lines = spark.read.text(path).select(F.explode(F.json_object_keys("value")).alias("key"))
    return {r[0] for r in lines.distinct().collect()}


def require_keys(spark: SparkSession, path: str | Sequence[str], required: Sequence[str]) -> None:
    """Raise when no row of a JSON-lines file has one of ``required`` (S06). A schema would invent the column."""
    found = json_keys(spark, path)
    lacking = sorted(set(required) - found)
    if lacking:
        raise ValueError(f"{path}: no row has {lacking}; the file has {sorted(found)}")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-lines sink: UTF-8 as-is, NULL fields kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_splits(spark: SparkSession, paths: Mapping[str, str], schema: str | StructType,
                fmt: str = "json", with_order: bool = False) -> DataFrame:
    """Union of per-split files with a ``split`` column; absent paths are skipped.

    Existence is checked when the plan is built; ``ignoreMissingFiles`` does not
    cover inputs that never existed.
    """
    parts = []
    for split, p in paths.items():
        if not path_exists(spark, p):
            continue
        if fmt == "json":
            df = read_jsonl(spark, p, schema, with_order=with_order)
        else:
            df = spark.read.schema(schema).format(fmt).load(p)
        parts.append(df.withColumn("split", F.lit(split)))
    if not parts:
        raise FileNotFoundError(f"none of the split files exist: {sorted(paths.values())}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def write_split_csv(df: DataFrame, path: str, split: str = "split") -> None:
    """Per-split CSV snapshot with header (S03): one folder per split value."""
    (df.write.mode("overwrite").partitionBy(split).option("header", True)
     .option("quote", '"').option("escape", '"').csv(path))


def write_csv(df: DataFrame, path: str, single_file: bool = False,
              rename: Mapping[str, str] | None = None) -> None:
    """Report / confusion / pairs / summary CSV (S09); values may hold newlines, quotes, commas.

    ``single_file`` coalesces to one task; use it only for small result tables.
    """
    out = df
    for a, b in (rename or {}).items():
        out = out.withColumnRenamed(a, b)
    if single_file:
        out = out.coalesce(1)
    (out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .csv(path))


def _csv_field(c: Column) -> Column:
    return F.when(c.rlike('[",\n\r]') | (c == ""), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def write_wide_confusion(wide: DataFrame, labels: Sequence[str], path: str) -> None:
    """Wide confusion CSV (A06) of a given label list: a header of labels, then a line per gold label in the order of ``labels``.

    Lines are written as text, so labels that no column could be called (case
    variants, dots, quotes, newlines) are plain quoted fields. For a label list in a table, or one
    of many thousands, see ``write_wide_pairs``.
    """
    spark = wide.sparkSession
    at = spark.createDataFrame([("gold", -1, list(labels))], "gold string, at int, cells array<string>")
    order = spark.createDataFrame(list(enumerate(labels)), "at int, gold string")
    rows = wide.join(order, "gold").select("gold", "at", F.col("counts").cast("array<string>").alias("cells"))
    lines = at.unionByName(rows).select("at", F.array_join(F.transform(F.concat(F.array("gold"), "cells"), _csv_field), ",").alias("value"))
    lines.repartition(1).sortWithinPartitions("at").select("value").write.mode("overwrite").text(path)


#: Cells of a wide confusion table that one file holds.
CELLS_PER_FILE = 50_000_000


def write_wide_pairs(pairs: DataFrame, ids: DataFrame, path: str, cells_per_file: int = CELLS_PER_FILE) -> int:
    """Wide confusion CSV (A06) from sparse pairs (gold, pred, count) and a table of labels (label, label_id from 0 on).

    A header of labels, then a line per gold label by label_id. The label list stays a table, a line is
    put together from its own cells and runs of zeros, and lines are dealt to files of about
    ``cells_per_file`` cells by their place, each with the header: ``file=0``, ``file=1`` and so on if there are
    several. Pairs whose labels are not in the table are left out. Returns the number of files.
    """
    n = ids.count()
    per_file = max(1, cells_per_file // max(1, n))
    files = max(1, -(-n // per_file))
    places = ids.select(F.col("label"), F.col("label_id").cast("int").alias("at"))
    cells = (pairs.join(places.withColumnsRenamed({"label": "pred", "at": "_col"}), "pred").join(places.withColumnRenamed("label", "gold"), "gold")
             .groupBy("at").agg(F.array_sort(F.collect_list(F.struct("_col", "count"))).alias("cells")))
    none = F.lit(",0")
    # neighbours of a cell by position: the list of places once, then the text of each cell
    placed = cells.select("at", "cells", F.transform("cells", lambda x: x["_col"]).alias("cols"))
    text = F.transform("cells", lambda c, i: F.concat(F.repeat(none, c["_col"] - F.coalesce(F.get("cols", i - 1), F.lit(-1)) - 1), F.lit(","), c["count"].cast("string")))
    tail = F.repeat(none, F.lit(n - 1) - F.element_at("cols", -1))
    filled = placed.select("at", F.concat(F.array_join(text, ""), tail).alias("cells"))
    lines = (places.join(filled, "at", "left")
             .select(F.floor(F.col("at") / per_file).cast("int").alias("file"), "at", F.concat(_csv_field(F.col("label")), F.coalesce("cells", F.repeat(none, F.lit(n)))).alias("value")))
    heads = places.agg(F.array_sort(F.collect_list(F.struct("at", "label"))).alias("all"))
    heads = heads.select(F.explode(F.sequence(F.lit(0), F.lit(files - 1))).alias("file"), F.lit(-1).alias("at"),
                         F.concat_ws(",", F.lit("gold"), F.transform("all", lambda x: _csv_field(x["label"]))).alias("value"))
    out = lines.unionByName(heads).repartition(files, "file").sortWithinPartitions("file", "at")
    if files == 1:
        out.select("value").write.mode("overwrite").text(path)
    else:
        out.select("file", "value").write.mode("overwrite").partitionBy("file").text(path)
    return files


# A null marker no CSV field holds: lets empty fields read back as '' instead of NULL.
_NO_NULL = "\u0000"


def read_csv(spark: SparkSession, path: str, schema: str | StructType, empty_as_null: bool = True) -> DataFrame:
    """CSV scan that survives quoted multi-line values.

    ``empty_as_null=False`` reads empty fields as ``''`` (report labels may be empty strings). Files
    larger than Spark's block are read by several tasks, see ``blocks.read_quoted_csv``; smaller ones, and
    folders partitioned by a column, by a task each. Both give the same rows.
    """
    null_value = None if empty_as_null else _NO_NULL
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    largest = files.agg(F.max("length")).first()[0] or 0
    block = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    if largest > block and spark.read.text(path).columns == ["value"]:
        return blocks.read_quoted_csv(spark, path, schema, null_value)
    r = (spark.read.schema(schema).option("header", True).option("multiLine", True)
         .option("quote", '"').option("escape", '"'))
    if null_value is not None:
        r = r.option("nullValue", null_value)
    return r.csv(path)


def write_report_csv(report: DataFrame, path: str) -> None:
    """Per-label report with the header ``f1-score`` (S09); a folder of files in the report's order.

    The label universe grows with what a model makes up, so the report is not
    gathered into one task.
    """
    write_csv(report.select("label", "precision", "recall", "f1_score", F.col("support").cast("double")),
              path, rename={"f1_score": "f1-score"})


def write_metrics_json(metrics: DataFrame, path: str, decimals: int | None = 10) -> None:
    """Metrics JSON (S08): doubles rounded to ``decimals`` like the reference's pandas writer;
    ``decimals=None`` keeps full doubles like its encoder writer. Metric frames are a few rows."""
    cols = [F.round(F.col(f.name), decimals).alias(f.name)
            if decimals is not None and f.dataType.typeName() in ("double", "float") else F.col(f.name)
            for f in metrics.schema.fields]
    metrics.select(*cols).coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema: str = METRICS_SCHEMA) -> DataFrame:
    """Metric records with every known key as a nullable column (S11 input)."""
    return spark.read.schema(schema).json(path)


def write_label_metadata(ids: DataFrame, path: str) -> None:
    """Label metadata (S07): the sorted label list with its dense ids, one JSON line per label.

    Long form (``label, label_id``) rather than one JSON array, so the sink
    scales with the vocabulary.
    """
    ids.select("label", "label_id").write.mode("overwrite").json(path)


def read_label_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("label string, label_id int").json(path)


def read_training_logs(spark: SparkSession, runs: Mapping[str, str], schema: str = LOG_SCHEMA,
                       required: Sequence[str] = ("train_mean_nll", "progress")) -> DataFrame:
    """Training logs of several runs with a ``run`` column and file-order ``step`` keys.

    Missing files are skipped (the reference prints a warning); a run none of
    whose rows carries a required key is dropped, as the reference skips a log
    whose frame lacks the column.
    """
    parts = []
    for run, p in runs.items():
        if not path_exists(spark, p):
            continue
        parts.append(read_jsonl(spark, p, schema, with_order=True).withColumn("run", F.lit(run)))
    if not parts:
        return spark.createDataFrame([], f"{schema}, {', '.join(c + ' ' + t for c, t in zip(ORDER_COLS, ('bigint', 'string', 'bigint', 'bigint')))}, run string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    has = out.groupBy("run").agg(*[F.count(F.col(c)).alias(c) for c in required]).collect()  # a row per run
    return out.where(F.col("run").isin([r["run"] for r in has if all(r[c] > 0 for c in required)]))
