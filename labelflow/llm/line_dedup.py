"""Line deduplication over a suffix array of line ids.

The corpus is one sequence of line ids in (id, row) order; blank lines don't take part.
Suffixes are ranked by their first 1, 2, 4, ... lines: a round joins each suffix's rank with
the rank of the suffix that many lines further on in the same document and ranks the pairs by
a range sort, so ranks keep the suffix order. A suffix whose prefix does not repeat is settled
and leaves. Suffixes with equal rank at 2^k are one interval of longest common prefix 2^k or more;
two overlapping ranks name the interval of any length between 2^k and 2^(k+1).

A repeated run counts if it holds at least ``min_words`` words. Every such run is covered by
the shortest runs of that many words that start or end at one of its lines, so these windows are
looked up in the intervals: the window that comes first in the corpus stays, the lines of all
later ones are deleted. As every line has a word, no window has more lines than ``min_words``
and log2(min_words) rounds suffice.

Only DataFrame functions run. Lines are compared by two 64-bit hashes of their trimmed text.
Null and empty texts have no lines and stay as they are. Texts without a deletion stay as they
are, others keep their remaining lines, blank ones included. Copies in one document count like
copies elsewhere. Repeated rows are copies of each other; null ids come first. Other columns
are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelflow.llm.common import ROW_ID, fresh, materialise, with_row_id

MIN_WORDS = 50


def _lines(rows: DataFrame) -> DataFrame:
    """One row per non-blank line: row id, id, n (such lines in the row), seq, line_no, two hashes, words."""
    split = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line_no"), F.regexp_replace(x, r"^\s+|\s+$", "").alias("line")))
    full = F.filter(split, lambda x: x["line"] != "")
    # the array passes through a generator, so it is built once per row
    seen = rows.select(ROW_ID, "id", F.explode(F.array(full)).alias("full")).select(
        ROW_ID, "id", F.size("full").alias("n"), F.posexplode("full").alias("seq", "x"))
    line = F.col("x.line")
    return seen.select(ROW_ID, "id", "n", "seq", F.col("x.line_no").alias("line_no"), F.xxhash64(line).alias("h1"),
                       F.xxhash64(F.lit(1), line).alias("h2"), F.size(F.split(line, r"\s+")).alias("words"))


def _starts(lines: DataFrame) -> DataFrame:
    """(row id, start): position of each row's first line in the corpus, by prefix sums over a range sort."""
    heads = materialise(lines.where("seq = 0").select(ROW_ID, "id", "n").repartitionByRange("id", ROW_ID)
                        .withColumn("part", F.spark_partition_id()), "line-heads")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = heads.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("id", ROW_ID).rowsBetween(Window.unboundedPreceding, -1)
    return (heads.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(bases, "part")
            .select(ROW_ID, (F.col("base") + F.col("inside")).alias("start")))


def _ranked(pairs: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """(g, row id, rank) of the suffixes of ``pairs`` whose pair repeats; ranks ascend with the pairs."""
    repeated = pairs.groupBy(a, b).agg(F.count("*").alias("__n")).where(F.col("__n") > 1).select(a, b)
    ranks = materialise(repeated.repartitionByRange(a, b).sortWithinPartitions(a, b)
                        .withColumn("rank", F.monotonically_increasing_id()), f"{name}-ranks")
    return materialise(pairs.join(ranks, [a, b]).select("g", ROW_ID, "rank"), name)


def _windows(active: DataFrame, min_words: int) -> DataFrame:
    """(g, length): shortest runs of consecutive active lines with ``min_words`` words that start or end at a line."""
    order = Window.partitionBy(ROW_ID).orderBy("g")  # the lines of one text
    island = active.withColumn("island", F.col("g") - F.row_number().over(order))
    line = Window.partitionBy(ROW_ID, "island").orderBy("g")
    ends = island.withColumn("z", F.sum("words").over(line.rowsBetween(Window.unboundedPreceding, 0))).withColumn("a", F.col("z") - F.col("words"))
    ahead = Window.partitionBy(ROW_ID, "island").orderBy("a").rangeBetween(0, min_words - 1)
    behind = Window.partitionBy(ROW_ID, "island").orderBy("z").rangeBetween(-(min_words - 1), 0)
    both = ends.select("g", F.count("*").over(ahead).alias("n1"), F.sum("words").over(ahead).alias("w1"),
                       F.count("*").over(behind).alias("n2"), F.sum("words").over(behind).alias("w2"))
    return (both.where(F.col("w1") >= min_words).select("g", F.col("n1").alias("length"))
            .union(both.where(F.col("w2") >= min_words).select(F.col("g") - F.col("n2") + 1, "n2")).distinct())


def later_copies(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row id, deleted): line numbers of later copies of repeated runs, for rows (row id, id, text) that have any."""
    lines = materialise(_lines(rows), "lines")
    repeated = lines.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2")
    active = materialise(lines.join(materialise(repeated, "repeated-lines"), ["h1", "h2"], "left_semi").join(_starts(lines), ROW_ID)
                         .select((F.col("start") + F.col("seq")).alias("g"), ROW_ID, "line_no", "words", "h1", "h2"), "active-lines")
    windows = materialise(_windows(active, min_words).withColumn("level", F.floor(F.log2("length")).cast("int")), "line-windows")
    deepest = windows.agg(F.max("level")).first()[0]
    level = _ranked(active, "h1", "h2", "suffixes-1")
    levels = level.select(F.lit(0).alias("level"), "g", "rank")
    for k in range(1, (deepest or 0) + 1):
        half = 1 << (k - 1)
        here, there = level.alias("here"), level.alias("there")
        pairs = materialise(
            here.join(there, (F.col(f"here.{ROW_ID}") == F.col(f"there.{ROW_ID}")) & (F.col("here.g") + half == F.col("there.g")))
            .select("here.g", f"here.{ROW_ID}", F.col("here.rank").alias("r1"), F.col("there.rank").alias("r2")), f"suffix-pairs-{2 * half}")
        level = _ranked(pairs, "r1", "r2", f"suffixes-{2 * half}")
        levels = levels.union(level.select(F.lit(k), "g", "rank"))
    tail = F.col("g") + F.col("length") - F.expr("shiftleft(1, level)")
    named = materialise(windows.withColumn("tail", tail)
                        .join(levels.withColumnRenamed("rank", "r1"), ["level", "g"])
                        .join(levels.select("level", F.col("g").alias("tail"), F.col("rank").alias("r2")), ["level", "tail"])
                        .select("g", "length", "r1", "r2"), "named-windows")
    first = materialise(named.groupBy("length", "r1", "r2").agg(F.min("g").alias("first")), "first-windows")
    later = (named.join(first, ["length", "r1", "r2"]).where(F.col("g") > F.col("first"))
             .select(F.explode(F.sequence("g", F.col("g") + F.col("length") - 1)).alias("g")).distinct())
    return active.join(later, "g").groupBy(ROW_ID).agg(F.sort_array(F.collect_list("line_no")).alias("deleted"))


def dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` with later copies deleted from ``text_col``, then __n_lines and __deleted (line numbers).

    The last two get further underscores if ``docs`` has columns of these names.
    """
    # columns go by position inside, so that any names may come in
    names = [f"c{k}" for k in range(len(docs.columns))]
    text_at = names[docs.columns.index(text_col)]
    kept = materialise(with_row_id(docs.toDF(*names)), "line-docs", "zstd")
    rows = kept.select(ROW_ID, kept[names[docs.columns.index(id_col)]].alias("id"), kept[text_at].cast("string").alias("text"))
    gone = materialise(later_copies(rows, min_words), "deleted-lines")
    # the lines pass through a generator after the join: texts move once, and are split once per row
    # (the deletions grow with the corpus: both sides are shuffled at any size)
    both = kept.join(gone.hint("merge"), ROW_ID, "left").select("*", F.explode(F.array(F.split(text_at, "\n"))).alias("lines"))
    n = F.coalesce(F.size("lines"), F.lit(0))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "deleted")
    text = F.when(F.col("deleted").isNull(), F.col(text_at)).otherwise(
        F.array_join(F.transform(left, lambda i: F.col("lines")[i]), "\n"))
    out = both.select(*[text.alias(c) if c == text_at else F.col(c) for c in names], F.when(F.col(text_at).isNull(), 0).otherwise(n).alias("n_lines"),
                      F.coalesce("deleted", F.array().cast("array<int>")).alias("deleted"))
    return out.toDF(*docs.columns, fresh("__n_lines", docs.columns), fresh("__deleted", docs.columns))
