"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.session import scratch_dir

ROW_ID = "__row_id"


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, as ``--py-files`` would, once per Spark application."""
    context = spark.sparkContext
    if getattr(context, "_labelflow_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # the archive is served from this folder of the driver for as long as the application runs
    folder = tempfile.mkdtemp(prefix="py-files-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    staged = os.path.join(folder, "staged", os.path.basename(package))
    shutil.copytree(package, staged, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(staged, "zip", os.path.dirname(staged), os.path.basename(package)))
    context._labelflow_shipped = True


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: later jobs reread files, also after an executor is lost, and
    values such as row ids stay as they were written.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, or with underscores added until no column is called so."""
    taken = {x.lower() for x in taken}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_id(df: DataFrame, name: str = ROW_ID) -> DataFrame:
    """Adds a unique long; stable only once the result has been written."""
    return df.withColumn(name, F.monotonically_increasing_id())


def parts(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[list[list]]:
    """Columns of small slices of Arrow batches as Python lists; bounds the memory of a task."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            piece = batch.slice(at, rows)
            yield [piece.column(i).to_pylist() for i in range(piece.num_columns)]


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, by position, whatever else the table holds."""
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))


def numbered(docs: DataFrame, id_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    """(row id, id, text); ``row_col`` names unique longs of the table itself, so that results can be joined back."""
    rid = F.monotonically_increasing_id() if row_col is None else docs[row_col]
    return docs.select(rid.alias(ROW_ID), docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))


def field(name: str, df: DataFrame, col: str) -> str:
    """DDL of an output column with the type of ``df[col]``."""
    return f"`{name}` {df.schema[col].dataType.simpleString()}"


def file_bytes(path: str, most: int = 64 << 20) -> bytes:
    """A tokenizer file, read on the driver and broadcast; refuses files over ``most`` bytes."""
    with open(path, "rb") as f:
        data = f.read(most + 1)
    if len(data) > most:
        raise ValueError(f"{path} is larger than {most} bytes")
    return data


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """crc32(id as text) mod ``folds`` is ``fold``; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))
