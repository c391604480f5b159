"""A training corpus from ``documents``: five stages, each over all rows that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes every stage's result to the shared folder and reads it back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.llm import bpe, decontaminate, langid, line_dedup, simhash
from labelflow.llm.common import ROW_ID, fresh, held_out, materialise, ship_package, with_row_id

MIN_LANGUAGE_SCORE = 0.5
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: no letters, or no learned language scores enough."""
    ship_package(spark)
    model = langid.train(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return langid.select_rows(docs, model, min_score=MIN_LANGUAGE_SCORE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs; a document of which nothing is left goes."""
    ship_package(spark)
    out = line_dedup.dedup_rows(docs)
    n_lines, deleted = out.columns[-2:]
    emptied = (F.size(deleted) > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    return out.where(~F.coalesce(emptied, F.lit(False))).withColumn(
        "n_chars", F.when(F.size(deleted) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).drop(n_lines, deleted)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the smallest doc_id, of each group of linked fingerprints."""
    ship_package(spark)
    row = fresh(ROW_ID, docs.columns)
    rows = materialise(with_row_id(docs, row), "simhash-docs", "zstd")
    kept = simhash.near_duplicates(rows, shingle=3, max_bits=2, row_col=row).where("keep").select(F.col(ROW_ID).alias(row))
    return rows.join(kept.hint("merge"), row, "left_semi").drop(row)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that share a window of words with a benchmark item."""
    ship_package(spark)
    row = fresh(ROW_ID, docs.columns)
    rows = materialise(with_row_id(docs, row), "benchmark-docs", "zstd")
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    bad = decontaminate.contaminated_words(rows, items, row_col=row).where("n_hit > 0").select(F.col(ROW_ID).alias(row))
    return rows.join(bad.hint("merge"), row, "left_anti").drop(row)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (little-endian unsigned 32-bit), with digests of them and of the bytes they decode to."""
    ship_package(spark)
    both = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [("language ID", language_id), ("line dedup", lines), ("SimHash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark), ("byte-level BPE", tokens)]

#: Learned models, fingerprints and merges have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{k + 1}-{name.replace(' ', '-')}")
    return docs
