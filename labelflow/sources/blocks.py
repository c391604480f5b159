"""Files read by many tasks whose rows depend on what stands before them in the file.

Spark's text source cuts a file into blocks at line breaks. What a block needs from the blocks before it is
one small number - lines so far, or whether a quoted field is open - so a first pass reduces each block
to that number, prefix sums (or parities) over the blocks give where each block stands, and a second
pass numbers its lines, or puts its lines together to records.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType, _parse_datatype_string
from pyspark.sql.window import Window

#: Blocks whose offsets are broadcast; a row of a few numbers for each. Beyond, they are joined by shuffling.
BROADCAST_BLOCKS = 100_000


def part_number(path: Column) -> Column:
    """Number of a Spark part file, 0 for any other file."""
    return F.coalesce(F.try_to_number(F.regexp_extract(path, r"part-(\d{1,18})[^/]*$", 1), F.lit("9" * 18)).cast("bigint"), F.lit(0).cast("bigint"))


def not_blank(line: Column) -> Column:
    return F.length(F.regexp_replace(line, r"(?U)[\s\x1c-\x1f]", "")) > 0


def _file_order(extra: Sequence[str] = ()) -> list:
    return [part_number(F.col("file")), "file", "block", *extra]


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(value, line): the non-blank lines of files, numbered from 0 in file order without gaps.

    Part files go by number, other files by name. The numbers don't depend on how files are cut
    into blocks or packed into tasks.
    """
    lines = (spark.read.text(list(path) if not isinstance(path, str) else path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at"))
             .where(not_blank(F.col("value"))))
    # blank lines have taken numbers too: count the others up to each line inside its block
    kept = lines.groupBy("file", "block", "task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.max("at").alias("last"))
    before = F.sum("n").over(Window.orderBy(*_file_order()).rowsBetween(Window.unboundedPreceding, -1))  # a row for each block
    offsets = kept.select("file", "block", "task", "first", "n", (F.col("last") - F.col("first") + 1 == F.col("n")).alias("dense"), F.coalesce(before, F.lit(0)).alias("before"))
    known = offsets.collect() if offsets.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS else None
    if known is not None:
        offsets = F.broadcast(spark.createDataFrame(known, offsets.schema))
    joined = lines.join(offsets, ["file", "block", "task"], "left")
    lost = F.raise_error(F.lit("files are cut into other blocks than when they were counted"))
    if known is not None and all(r["dense"] for r in known):
        inside = F.col("at") - F.col("first")
    else:
        inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("at")) - 1
    return joined.select("value", F.when(F.col("before").isNull(), lost.cast("bigint")).otherwise(F.col("before") + inside).alias("line"))


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Files under a path in file order, by Hadoop's listing; hidden files left out."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, entries = [], fs.listFiles(root, True)
    while entries.hasNext():
        p = entries.next().getPath()
        if not p.getName().startswith(("_", ".")):
            found.append(p.toString())

    def key(name: str):
        import re

        m = re.search(r"part-(\d{1,18})[^/]*$", name)
        return int(m[1]) if m else 0, name

    return sorted(found, key=key)


def first_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """(value, line): the first ``n`` non-blank lines in file order; only the files they stand in are opened."""
    files = list_files(spark, path)
    if n <= 0 or not files:
        return numbered_lines(spark, path).where(F.col("line") < n)
    take = 1
    while True:
        some = files[:take]
        if take >= len(files) or spark.read.text(some).where(not_blank(F.col("value"))).limit(n).count() >= n:
            return numbered_lines(spark, some).where(F.col("line") < n)
        take *= 2


# Quoted CSV

_PIECE = "file bigint, block bigint, kind int, head boolean, text string"
#: A record, the start of one that its block doesn't end, what goes on from the block before to its end, or through the block.
_WHOLE, _OPEN, _REST, _THROUGH = range(4)


def _records(batches: Iterable[pa.RecordBatch], inside: frozenset[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Lines (file, block, value, odd number of quotes) to records and pieces of records."""
    at, waiting, open_, first = None, [], False, False

    def rows(found):
        file, block, kind, head, text = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(file, pa.int64()), pa.array(block, pa.int64()), pa.array(kind, pa.int32()), pa.array(head, pa.bool_()), pa.array(text, pa.string())],
                                          names=["file", "block", "kind", "head", "text"])

    def left():
        """What the block that ends leaves open."""
        return [(*at, _THROUGH if open_ == "rest" else _OPEN, first, "\n".join(waiting))] if at is not None and open_ else []

    for batch in batches:
        files, blocks, values, odd = (c.to_pylist() if k == 2 else c.to_numpy(zero_copy_only=False) for k, c in enumerate(batch.columns))
        edges = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(values)]):
            if low == high:
                continue
            out = []
            here = (int(files[low]), int(blocks[low]))
            if here != at:
                out += left()
                at, waiting, open_, first = here, [], "rest" if here in inside else False, here[1] == 0
            after = (np.cumsum(odd[low:high]) + bool(open_)) % 2 == 1
            ends = np.flatnonzero(~after).tolist()
            begin = low
            for e in ends:
                end = low + e + 1
                text = values[begin] if not waiting and end == begin + 1 else "\n".join([*waiting, *values[begin:end]])
                kind = _REST if open_ == "rest" else _WHOLE
                if kind == _REST or text not in ("", "\r"):
                    out.append((*at, kind, first, text))
                    first = first and kind == _REST
                waiting, open_, begin = [], False, end
            if begin < high:
                waiting += values[begin:high]
                open_ = open_ or True
            for k in range(0, len(out), 5000):
                yield rows(out[k : k + 5000])
    if open_:
        yield rows(left())


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(head, text): the records of CSV files, each file read by as many tasks as it has blocks.

    ``head`` marks the first record of a file. Fields that hold quotes, separators or line breaks must be
    quoted, and quotes in them doubled; lines end with line feeds, with or without carriage returns.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    lines = text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", quotes.cast("int").alias("odd"))
    parity = lines.groupBy("file", "block").agg((F.sum("odd") % 2).alias("odd"))
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    entered = parity.withColumn("before", F.sum("odd").over(order)).where(F.col("before") % 2 == 1)
    # blocks that begin inside a quoted field: two numbers for a block at most, 16 bytes for 128 MB of text
    inside = frozenset((r["file"], r["block"]) for r in entered.select("file", "block").collect())
    pieces = lines.mapInArrow(lambda batches: _records(batches, inside), _PIECE)
    if not inside:
        return pieces.select("head", "text")
    # a record that several blocks hold belongs to the block it starts in
    cut = pieces.where(F.col("kind") != _WHOLE)
    starts = F.when(F.col("kind") == _OPEN, F.col("block"))
    ordered = Window.partitionBy("file").orderBy("block", F.col("kind") == _OPEN)
    joined = (cut.withColumn("owner", F.last(starts, ignorenulls=True).over(ordered))
              .groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "head", "text"))).alias("parts")))
    # inside an owner: its start, whole blocks, and the rest
    whole = joined.select(F.exists("parts", lambda p: (p["kind"] == _OPEN) & p["head"]).alias("head"), F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    return pieces.where(F.col("kind") == _WHOLE).select("head", "text").unionByName(whole)


def read_quoted_csv(spark: SparkSession, path: str, schema: str | StructType | DataType, null_value: str | None = None) -> DataFrame:
    """CSV with a header in each file and quoted multi-line values, one file read by many tasks."""
    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"} | ({} if null_value is None else {"nullValue": null_value})
    rows = quoted_records(spark, path).where(~F.col("head"))
    # every field is there in a record of the right width, so a record is never null itself
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kind.fields)
    return rows.select(F.from_csv(F.regexp_replace("text", "\r$", ""), ddl, options).alias("r")).select("r.*")
