"""Columns called like those operators use inside change nothing and come out as they went in."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from labelflow.llm import collocations, decontaminate, line_dedup, periodic_runs, simhash, suffix_dedup
from tests.llm.conftest import prose

NAMES = ["__row_id", "deleted", "__lines", "__n_lines", "__deleted", "hash", "pos", "fp", "c0", "text_", "a.b", "h", "k1", "lang_", "row", "keep"]


@pytest.fixture(scope="module")
def both(spark):
    passage = prose(7, 60)
    texts = [(1, prose(1, 90)), (2, prose(2, 90) + "\n" + passage), (3, passage + "\n" + prose(3, 30)), (4, prose(1, 90)), (5, None), (6, prose(900, 30) + " " + prose(9, 20)), (7, "")]
    plain = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in texts], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = plain
    for k, name in enumerate(NAMES):
        value = F.lit("x") if k % 2 else F.lit(77).cast("long")
        extra = extra.withColumn(name, value)
    return plain, extra


def rows(df, *cols):
    return sorted(map(repr, df.select(*cols).collect()))


def test_line_dedup(both):
    plain, extra = both
    out = line_dedup.dedup_rows(extra)
    assert out.columns[:-2] == extra.columns and out.columns[-2:] == ["__n_lines_", "__deleted_"]
    renamed = line_dedup.dedup_rows(plain).withColumnsRenamed({"__n_lines": "__n_lines_", "__deleted": "__deleted_"})
    assert rows(out, "doc_id", "text", "__n_lines_", "__deleted_") == rows(renamed, "doc_id", "text", "__n_lines_", "__deleted_")
    assert {tuple(r) for r in out.select("__row_id", "deleted", "`a.b`").distinct().collect()} == {(77, "x", 77)}
    assert max(len(r["__deleted_"]) for r in out.collect()) > 0


@pytest.mark.parametrize("make", [
    lambda d: simhash.near_duplicates(d, shingle=3, max_bits=2).drop("__row_id"),
    lambda d: decontaminate.contaminated_words(d, d.sparkSession.createDataFrame([(1, prose(900, 30))], "item_id bigint, text string")).drop("__row_id"),
    lambda d: suffix_dedup.deduplicate(d),
    lambda d: periodic_runs.find(d),
    lambda d: collocations.mine(d, least=2),
])
def test_same_rows(both, make):
    plain, extra = (make(d) for d in both)
    assert plain.columns == extra.columns and rows(plain, *plain.columns) == rows(extra, *extra.columns)


def test_row_ids_of_the_table_itself_are_returned(both):
    plain, _ = both
    given = plain.withColumn("mine", F.col("doc_id") * 10)
    out = simhash.near_duplicates(given, shingle=3, max_bits=2, row_col="mine")
    assert {(r["doc_id"], r["__row_id"]) for r in out.collect()} == {(i, i * 10) for i in range(1, 8)}


def test_pipeline_stages_keep_such_columns(spark, both, tmp_path):
    plain, extra = both
    spark.createDataFrame([(1, prose(900, 30))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name in ("line dedup", "SimHash near-dedup", "benchmark decontamination"):
        stage = dict(P.STAGES)[name]
        one, two = stage(spark, plain, str(tmp_path)), stage(spark, extra, str(tmp_path))
        assert two.columns == extra.columns and rows(one, "doc_id", "text") == rows(two, "doc_id", "text")
        assert {tuple(r) for r in two.select("__row_id", "keep").distinct().collect()} == {(77, "x")}
