"""Label vocabularies and label <-> id encoding.

A vocabulary is a small DataFrame ``(label)``. Where a plan needs it inline
(prompt text, extraction maps) it is collected: the caller asks for text that
spells the labels out, at any size. Joins against it broadcast an id table of
checked size and salt a larger one; both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.functions.text import py_strip

# An id table of at most this many rows is broadcast; a larger one is joined on a salted key.
BROADCAST_ROWS = 100_000
SALTS = 32


def vocab_from_split(df: DataFrame, label: str = "label_text", split: str = "split",
                     split_value: str = "train", include_oos: bool = False,
                     oos_label: str = "oos") -> DataFrame:
    """Distinct non-null labels of one split; ``oos`` dropped unless ``include_oos``."""
    v = df.where((F.col(split) == split_value) & F.col(label).isNotNull()).select(F.col(label).alias("label"))
    if not include_oos:
        v = v.where(F.col("label") != oos_label)
    return v.distinct()


def vocab_union(*cols: tuple[DataFrame, str], strip: bool = True) -> DataFrame:
    """Set union of label columns of several tables; stripped, blanks dropped."""
    parts = []
    for df, c in cols:
        x = py_strip(F.col(c)) if strip else F.col(c)
        parts.append(df.select(x.alias("label")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("label").isNotNull() & (F.col("label") != "")).distinct()


def label_universe(df: DataFrame, gold: str = "gold_label", pred: str = "predicted_label") -> DataFrame:
    """gold ∪ predicted labels of a predictions table."""
    return (df.select(F.explode(F.array(F.col(gold), F.col(pred))).alias("label"))
            .where(F.col("label").isNotNull()).distinct())


def collect_labels(vocab: DataFrame, label: str = "label") -> list[str]:
    """Sorted labels of a vocabulary DataFrame, for prompts and expressions that spell them out."""
    rows = vocab.select(F.col(label).alias("label")).where(F.col("label").isNotNull()).distinct().collect()
    return sorted(r["label"] for r in rows)


def label_ids(vocab: DataFrame, label: str = "label") -> DataFrame:
    """Dense ``label_id`` from 0 in code-point order, as ``enumerate(sorted(labels))``.

    The ids come from ``group_ordinal`` over a single group: labels are range
    partitioned across tasks and numbered with per-partition offsets, so a
    vocabulary that grows with the data (hallucinated labels) is never sorted
    in one task.
    """
    from labelflow.operators.sampling import group_ordinal

    v = vocab.select(F.col(label).alias("label")).distinct().withColumn("_all", F.length("label") < 0)
    return group_ordinal(v, "_all", "label", out="label_id").select(
        "label", F.col("label_id").cast("int").alias("label_id"))


def vocab_by_length(vocab: DataFrame, label: str = "label") -> DataFrame:
    """Vocabulary ordered longest first, ties alphabetical, with its 0-based position."""
    from labelflow.operators.sampling import group_ordinal

    v = (vocab.select(F.col(label).alias("label")).distinct()
         .select("label", F.length("label").alias("length"), (-F.length("label")).alias("_neg"),
                 (F.length("label") < 0).alias("_all")))
    return group_ordinal(v, "_all", ["_neg", "label"], out="position").select(
        "label", "length", F.col("position").cast("int").alias("position"))


def lookup(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Left join of facts with a small table on a few-valued key, without gathering a key in one task."""
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(ids), key, "left")
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[c for c in df.columns if c != key] or [key]), F.lit(SALTS)).cast("int"))
    spread = ids.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, [key, "__salt"], "left").drop("__salt")


def encode_labels(df: DataFrame, ids: DataFrame, label: str = "label", out: str = "label_id",
                  on_unknown: str = "error") -> DataFrame:
    """label -> id by equi-join on the id table (L05, J01); see ``lookup`` for skew.

    ``on_unknown="error"`` raises at run time on a label outside the vocabulary,
    like the reference's ``label2id[label]``; ``"null"`` keeps the row with a NULL id.
    """
    joined = lookup(df, ids.select(F.col("label").alias(label), F.col("label_id").alias(out)), label)
    if on_unknown == "error":
        joined = joined.withColumn(out, F.when(F.col(out).isNull() & F.col(label).isNotNull(),
                                               F.raise_error(F.concat(F.lit("unknown label: "), F.col(label))))
                                   .otherwise(F.col(out)))
    elif on_unknown != "null":
        raise ValueError("on_unknown must be 'error' or 'null'")
    return joined


def decode_labels(df: DataFrame, ids: DataFrame, id_col: str = "label_id", out: str = "label") -> DataFrame:
    """id -> label by equi-join on the id table."""
    return lookup(df, ids.select(F.col("label_id").alias(id_col), F.col("label").alias(out)), id_col)
