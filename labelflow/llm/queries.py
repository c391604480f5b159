"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.llm import bpe, collocations, decontaminate, embeddings, html_text, langid, line_dedup, periodic_runs, pii, simhash, suffix_dedup, token_files, toxicity
from labelflow.llm.common import ROW_ID, held_out, ship_package
from labelflow.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _register(fn):
    @wraps(fn)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = query
    return query


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


@_register
def op2_byte_bpe(spark, sf_dir):
    ids = bpe.encode(_read(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    both = bpe.decode(ids, BYTE_RANKS)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_register
def op8_decontaminate(spark, sf_dir):
    hits = decontaminate.contaminated_words(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


@_register
def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, max_bits=2).drop(ROW_ID, "keep")


@_register
def op1_langid(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    model = langid.train(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return langid.predict(docs, model).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


@_register
def op3_toxicity(spark, sf_dir):
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"), 3, 1)))
    return (toxicity.score(docs, model)
            .select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")))


@_register
def op5_token_files(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "token-files")
    manifest = token_files.write(docs, WORD_BPE, folder)
    return token_files.read(manifest, folder, "doc_id", docs.schema["doc_id"].dataType.simpleString())


@_register
def op7_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_rows(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").cast("long").alias("n_lines"), F.size("__deleted").cast("long").alias("n_deleted"),
                      F.array_join("__deleted", ",").alias("deleted"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@_register
def op4_pii(spark, sf_dir):
    out = pii.extract(_read(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return out.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.KINDS], F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
                      pii.written(pii.merged(F.col("base"), F.col("added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))


@_register
def op6_embedding_dedup(spark, sf_dir):
    return embeddings.near_duplicates(_read(spark, sf_dir, "embeddings"))


@_register
def op9_html_text(spark, sf_dir):
    return html_text.extract(_read(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


@_register
def op11_collocations(spark, sf_dir):
    return collocations.top(collocations.mine(_read(spark, sf_dir, "documents")), 2000)


@_register
def op12_suffix_dedup(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", *suffix_dedup.text_key(text), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("own"))
    cut = suffix_dedup.removed(docs).select("k1", "k2", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    zero = F.lit(0).cast("long")
    return rows.join(cut, ["k1", "k2"], "left").select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
                                                       F.coalesce("kept_sha256", "own").alias("kept_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``documents`` as op13 takes them: in every tenth text by crc32(doc_id) a period is planted from word a on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def planted(words):
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        return F.concat(F.slice(words, F.lit(1), a.cast("int")),
                        F.slice(F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int")))

    # a lambda's argument is evaluated once a row, however often it is named
    words = F.array(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    text = F.transform(words, lambda w: F.when(F.size(w) > 0, F.array_join(planted(w), " ")).otherwise(F.col("text")))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, text).otherwise(F.col("text")).alias("text"))


@_register
def op13_periodic_runs(spark, sf_dir):
    out = periodic_runs.find(with_planted_periods(_read(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                      F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                      F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


# Twins that need no approximation: all 10-word windows of the items, and all pairs of a label.
ORACLE["op8_decontaminate"] = r"""
WITH lower_d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
d AS (SELECT row_number() OVER () AS rid, doc_id, w FROM lower_d),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
wins AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, k, k + least(len(w), 10) - 1), ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)
),
grams AS (
  SELECT rid, k, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)
),
found AS (SELECT rid, k, n, item FROM grams JOIN wins USING (n, g)),
hit AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS place FROM found) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)"""

ORACLE["op6_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
ok AS (
  SELECT vec_id, label, e, len(e) AS dim FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b ON a.label = b.label AND a.dim = b.dim AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
),
reach AS (SELECT vec_id AS u, vec_id AS r FROM v UNION SELECT l.w, reach.r FROM reach JOIN link l ON l.u = reach.u WHERE reach.r < l.w),
root AS (SELECT u, min(r) AS r FROM reach GROUP BY u)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE u = v.vec_id) AS n_links, root.r AS component_id, v.vec_id = root.r AS kept
FROM v JOIN root ON root.u = v.vec_id"""

# All n-grams of up to three words, their cuts and what contains them.
ORACLE["op11_collocations"] = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents
),
gram AS (
  SELECT lang, size, w[k : k + size - 1] AS g, count(*) AS f
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM piece, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size)
  GROUP BY ALL
),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM gram WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, g, f FROM gram WHERE size > 1 AND f >= 10),
cut AS (SELECT lang, size, g, f, k, g[1 : k] AS lp, g[k + 1 :] AS rp FROM (SELECT *, unnest(range(1, size)) AS k FROM cand)),
scored AS (
  SELECT cut.lang, cut.g, cut.f AS a, l.f AS l, r.f AS r, cut.k, CAST((1000000::HUGEINT * cut.f * cut.f) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cut JOIN gram l ON l.lang = cut.lang AND l.g = cut.lp JOIN gram r ON r.lang = cut.lang AND r.g = cut.rp
),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
longer AS (SELECT lang, g, max(f) AS f FROM (
  SELECT lang, g[1 : 2] AS g, f FROM cand WHERE size = 3 UNION ALL SELECT lang, g[2 : 3], f FROM cand WHERE size = 3) GROUP BY ALL),
stays AS (SELECT w.* FROM weakest w LEFT JOIN longer x ON x.lang = w.lang AND x.g = w.g WHERE x.f IS NULL OR 100 * x.f < 50 * w.a),
ranked AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM stays)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""
