"""Registered text, extraction and vocabulary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelflow.functions import extract as X
from labelflow.functions import text as T
from labelflow.operators import evaluate as ev
from labelflow.operators import vocab as V
from labelflow.plans import fixtures as fx
from labelflow.plans import oracle_sql as O
from labelflow.plans.registry import register

# --- DuckDB spellings of the Python string helpers (ASCII inputs only) -------


def s_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def s_norm(x: str) -> str:
    return f"regexp_replace(lower({s_strip(x)}), '\\s+', ' ', 'g')"


def s_first(x: str) -> str:
    return f"split_part({x}, chr(10), 1)"


def s_unquote(x: str) -> str:
    return f"trim(trim({x}, '\"'), chr(39))"


def s_in(v: str, x: str) -> str:
    return f"CASE WHEN list_contains({v}, {x}) THEN {x} END"


def s_words_best(vl: str, text: str) -> str:
    return f"list_filter({vl}, lambda l: list_contains(string_split_regex({text}, '[^a-zA-Z0-9_]+'), l))[1]"


# --- text ---------------------------------------------------------------------

@register("normalize_text", """
SELECT doc_id AS example_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS utterance FROM documents""")
def normalize_text(spark, sf):
    d = fx.table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("example_id"), T.normalize_ws("text").alias("utterance"))


@register("match_normalize", """
SELECT doc_id AS example_id, regexp_replace(lower(trim(text)), '\\s+', ' ', 'g') AS normalized FROM documents""")
def match_normalize(spark, sf):
    d = fx.table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("example_id"), T.match_normalize("text").alias("normalized"))


_MODEL_NAME = "concat(p_brand, '/', p_name, '-', p_type, '.', CAST(p_size AS VARCHAR))"


@register("name_slug", f"""
SELECT p_partkey, {_MODEL_NAME} AS model_name,
  lower(translate(string_split({_MODEL_NAME}, '/')[-1], '.-', '__')) AS slug,
  translate('few-shot', '-', '_') AS mode_slug
FROM part""")
def name_slug(spark, sf):
    p = fx.table(spark, sf, "part")
    name = F.concat(F.col("p_brand"), F.lit("/"), F.col("p_name"), F.lit("-"), F.col("p_type"), F.lit("."),
                    F.col("p_size").cast("string"))
    return p.select("p_partkey", name.alias("model_name"), T.name_slug(name).alias("slug"),
                    T.mode_slug(F.lit("few-shot")).alias("mode_slug"))


# --- extraction over F3 ---------------------------------------------------------

_F3_VOCAB = """
v AS (
  SELECT list(label ORDER BY label) AS V, list(label ORDER BY length(label) DESC, label) AS VL
  FROM (SELECT DISTINCT source AS label FROM documents WHERE source IS NOT NULL)
)"""


def _f3(spark, sf):
    rows = fx.f3_raw_outputs(spark, sf)
    labels = V.collect_labels(fx.table(spark, sf, "documents").select(F.col("source").alias("label")))
    return rows, labels


def _extract_sql(expr: str) -> str:
    return O.with_(O.F3_CTE, _F3_VOCAB) + f"""
SELECT example_id, gold_label, raw_prediction, {expr} AS predicted_label FROM src, v"""


@register("extract_first_line", _extract_sql(s_strip(s_first(s_strip("raw_prediction")))))
def extract_first_line(spark, sf):
    rows, _ = _f3(spark, sf)
    return rows.withColumn("predicted_label", X.extract_first_line("raw_prediction"))


_CAND = f"lower({s_strip(s_unquote(s_strip('raw_prediction')))})"


@register("extract_canonical", _extract_sql(
    f"coalesce({s_in('V', _CAND)}, {s_in('V', s_strip(s_first(_CAND)))}, "
    f"CASE WHEN {_CAND} = '' THEN '' END, {s_strip('raw_prediction')})"))
def extract_canonical(spark, sf):
    rows, labels = _f3(spark, sf)
    return rows.withColumn("predicted_label", X.extract_canonical("raw_prediction", labels))


_TXT = s_strip("raw_prediction")
_CLEAN = s_strip(s_unquote(_TXT))
_STRICT = (f"coalesce({s_in('V', s_norm(_TXT))}, {s_in('V', s_norm(_CLEAN))}, "
           f"CASE WHEN {_CLEAN} <> '' THEN {_CLEAN} END, {_TXT})")


@register("extract_strict", _extract_sql(_STRICT))
def extract_strict(spark, sf):
    rows, labels = _f3(spark, sf)
    return rows.withColumn("predicted_label", X.extract_strict("raw_prediction", labels))


_LOW = f"lower({_TXT})"
_PLAIN = (f"coalesce({s_in('V', _LOW)}, "
          f"list_filter(list_transform(string_split_regex({_LOW}, '[\\n,;:]+'), lambda c: {s_strip('c')}), "
          f"lambda c: list_contains(V, c))[1], "
          f"{s_words_best('VL', _LOW)}, "
          f"CASE WHEN {_TXT} = '' THEN '' ELSE {s_strip(s_first(_TXT))} END)")


@register("extract_cascade_plain", _extract_sql(_PLAIN))
def extract_cascade_plain(spark, sf):
    rows, labels = _f3(spark, sf)
    return rows.withColumn("predicted_label", X.extract_cascade_plain("raw_prediction", labels))


_NORM = s_norm(_TXT)
_CASCADE = (f"coalesce({s_in('V', _NORM)}, {s_in('V', s_norm(_CLEAN))}, "
            f"list_filter(list_transform(string_split_regex({_TXT}, '[\\n,;:]+'), "
            f"lambda c: {s_norm(s_strip(s_unquote(s_strip('c'))))}), lambda c: list_contains(V, c))[1], "
            f"{s_words_best('VL', _NORM)}, "
            f"CASE WHEN {_TXT} = '' THEN '' ELSE {s_strip(s_first(_TXT))} END)")


@register("extract_cascade", _extract_sql(_CASCADE))
def extract_cascade(spark, sf):
    rows, labels = _f3(spark, sf)
    return rows.withColumn("predicted_label", X.extract_cascade("raw_prediction", labels))


@register("extract_whole_word", _extract_sql(s_words_best("VL", _LOW)))
def extract_whole_word(spark, sf):
    rows, labels = _f3(spark, sf)
    return rows.withColumn("predicted_label", X.whole_word_label(F.lower(T.py_strip("raw_prediction")), labels))


@register("extract_cascade_metrics", O.with_(O.F3_CTE, _F3_VOCAB, f"""
ex AS (SELECT example_id, gold_label, {_CASCADE} AS predicted_label FROM src, v)""",
                                             O.metric_ctes(src="ex")) + "\n" + O.summary_sql())
def extract_cascade_metrics(spark, sf):
    rows, labels = _f3(spark, sf)
    scored = rows.withColumn("predicted_label", X.extract_label("raw_prediction", labels, "cascade"))
    return ev.summary_metrics(scored, decimals=10)


@register("oov_predictions", O.with_(O.F3_CTE, _F3_VOCAB, f"""
ex AS (SELECT {_STRICT} AS predicted_label FROM src, v)""") + """
SELECT predicted_label, count(*) AS count FROM ex
WHERE predicted_label NOT IN (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)
GROUP BY predicted_label""")
def oov_predictions(spark, sf):
    rows, labels = _f3(spark, sf)
    vocab = fx.table(spark, sf, "documents").select(F.col("source").alias("label")).distinct()
    scored = rows.withColumn("predicted_label", X.extract_strict("raw_prediction", labels))
    return ev.oov_predictions(scored, vocab)


# --- vocabularies ---------------------------------------------------------------

@register("label_vocab", O.with_(O.F1_CTE) + """
SELECT DISTINCT label_text AS label FROM src
WHERE split = 'train' AND label_text IS NOT NULL AND label_text <> 'oos'""")
def label_vocab(spark, sf):
    return V.vocab_from_split(fx.f1_raw_splits(spark, sf), include_oos=False)


@register("label_vocab_with_oos", O.with_(O.F1_CTE) + """
SELECT DISTINCT label_text AS label FROM src WHERE split = 'train' AND label_text IS NOT NULL""")
def label_vocab_with_oos(spark, sf):
    return V.vocab_from_split(fx.f1_raw_splits(spark, sf), include_oos=True)


_UNION_SQL = """
u AS (
  SELECT label FROM (
    SELECT trim(lang) AS label FROM documents
    UNION SELECT trim(source) FROM documents
    UNION SELECT trim(o_orderpriority) FROM orders)
  WHERE label IS NOT NULL AND label <> ''
)"""


def _union_vocab(spark, sf):
    d = fx.table(spark, sf, "documents")
    o = fx.table(spark, sf, "orders")
    return V.vocab_union((d, "lang"), (d, "source"), (o, "o_orderpriority"))


@register("label_vocab_union", O.with_(_UNION_SQL) + "\nSELECT label FROM u")
def label_vocab_union(spark, sf):
    return _union_vocab(spark, sf)


@register("vocab_by_length", O.with_(_UNION_SQL) + """
SELECT label, CAST(length(label) AS INTEGER) AS length,
  CAST(row_number() OVER (ORDER BY length(label) DESC, label) - 1 AS INTEGER) AS position FROM u""")
def vocab_by_length(spark, sf):
    return V.vocab_by_length(_union_vocab(spark, sf))


@register("label_ids", O.with_(_UNION_SQL) + """
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id FROM u""")
def label_ids(spark, sf):
    return V.label_ids(_union_vocab(spark, sf))


@register("encode_decode", O.with_(_UNION_SQL, """
ids AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id FROM u)""") + """
SELECT o.o_orderkey, i.label_id, i.label AS decoded
FROM orders o JOIN ids i ON i.label = o.o_orderpriority""")
def encode_decode(spark, sf):
    ids = V.label_ids(_union_vocab(spark, sf))
    o = fx.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label"))
    enc = V.encode_labels(o, ids, label="label", out="label_id", on_unknown="error")
    dec = V.decode_labels(enc.select("o_orderkey", "label_id"), ids, id_col="label_id", out="decoded")
    return dec.select("o_orderkey", "label_id", "decoded")


@register("label_universe", O.with_(O.f2_cte("a")) + """
SELECT gold_label AS label FROM src UNION SELECT predicted_label FROM src""")
def label_universe(spark, sf):
    return V.label_universe(fx.f2_predictions(spark, sf, "a"))


@register("extract_cascade_join", _extract_sql(_CASCADE))
def extract_cascade_join(spark, sf):
    """X05 through the join path used for vocabularies too large to inline."""
    rows = fx.f3_raw_outputs(spark, sf)
    vocab = fx.table(spark, sf, "documents").select(F.col("source").alias("label"))
    return X.extract_label_join(rows, "example_id", "raw_prediction", vocab, "cascade")


@register("extract_cascade_plain_join", _extract_sql(_PLAIN))
def extract_cascade_plain_join(spark, sf):
    rows = fx.f3_raw_outputs(spark, sf)
    vocab = fx.table(spark, sf, "documents").select(F.col("source").alias("label"))
    return X.extract_label_join(rows, "example_id", "raw_prediction", vocab, "cascade_plain")


# --- labels of several words ------------------------------------------------------

_PART_TEXT = "concat('order: ', lower(p_name), ' (', lower(p_type), ')\n', lower(p_brand), '-x, ', lower(p_brand))"


@register("extract_phrases", f"""
WITH v AS (
  SELECT list(label ORDER BY length(label) DESC, label) AS VL FROM (
    SELECT lower(p_name || ' (' || p_type) AS label FROM part WHERE p_partkey % 3 = 0 UNION SELECT lower(p_name) FROM part UNION SELECT lower(p_brand) FROM part
    UNION SELECT string_split(lower(p_name), ' ')[2] FROM part)
  WHERE label IS NOT NULL AND label <> ''
)
SELECT p_partkey, 
  list_filter(VL, lambda l: CASE WHEN contains(t, l) THEN regexp_matches(t, '(^|[^a-z0-9_])' || replace(l, '(', '\\(') || '($|[^a-z0-9_])') ELSE FALSE END)[1] AS label
FROM (SELECT p_partkey, {_PART_TEXT} AS t FROM part), v""")
def extract_phrases(spark, sf):
    """X06 with a label list of one to three words, and texts that hold several of them."""
    p = fx.table(spark, sf, "part")
    words = F.split(F.lower("p_name"), " ")
    labels = (p.where(F.col("p_partkey") % 3 == 0).select(F.lower(F.concat("p_name", F.lit(" ("), "p_type")).alias("label")).union(p.select(F.lower("p_name")))
              .union(p.select(F.lower("p_brand"))).union(p.select(F.get(words, F.lit(1)))).where("label <> ''"))
    text = F.concat(F.lit("order: "), F.lower("p_name"), F.lit(" ("), F.lower("p_type"), F.lit(")\n"), F.lower("p_brand"), F.lit("-x, "), F.lower("p_brand"))
    return p.select("p_partkey", X.whole_word_label(text, V.collect_labels(labels)).alias("label"))


_OPENING = "regexp_extract(lower(text), '^([a-z]+ [a-z]+)[ .]', 1)"


@register("extract_phrases_join", f"""
WITH labels AS (SELECT DISTINCT {_OPENING} AS label FROM documents WHERE {_OPENING} <> ''),
v AS (SELECT list(label) AS V FROM labels),
src AS (SELECT doc_id, text AS raw_prediction, lower({s_strip("text")}) AS low FROM documents),
inside AS (
  -- separators other than spaces are set off, so that a label's words are neighbours only as they are written
  SELECT doc_id, label FROM (SELECT doc_id, ' ' || regexp_replace(low, '([^\\p{{L}}\\p{{N}}_ ])', ' \\1 ', 'g') || ' ' AS t FROM src) x
  JOIN labels ON contains(t, ' ' || label || ' ')
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(label) DESC, label) = 1
)
SELECT doc_id, {_PLAIN.replace(s_words_best("VL", _LOW), "inside.label")} AS predicted_label FROM v, src LEFT JOIN inside USING (doc_id)""")
def extract_phrases_join(spark, sf):
    """J04 with a vocabulary table that grows with the documents: their first two words, looked for in all texts."""
    d = fx.table(spark, sf, "documents")
    vocab = d.select(F.regexp_extract(F.lower("text"), "^([a-z]+ [a-z]+)[ .]", 1).alias("label")).where("label <> ''")
    out = X.extract_label_join(d.select("doc_id", "text"), "doc_id", "text", vocab, "cascade_plain")
    return out.select("doc_id", "predicted_label")
