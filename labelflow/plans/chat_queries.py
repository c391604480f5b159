"""Registered record, prompt, conversation and sampling queries
(P01-P17, P20, S05, W02, W03, A08, A09, O03)."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelflow.functions import chat
from labelflow.operators import records as R
from labelflow.operators import sampling as S
from labelflow.operators import vocab as V
from labelflow.plans import fixtures as fx
from labelflow.plans import oracle_sql as O
from labelflow.plans.registry import register

NL2 = "chr(10) || chr(10)"

# --- shared pieces: F1 prepared with the train vocabulary ---------------------------------

_PREP_SQL = O.F1_CTE + """,
prep AS (
  SELECT example_id,
    CASE split WHEN 'validation' THEN 'val' ELSE split END AS split,
    trim(regexp_replace(text, '\\s+', ' ', 'g')) AS utterance,
    label_text AS label
  FROM src WHERE text IS NOT NULL AND label_text IS NOT NULL AND label_text <> 'oos'
),
lv AS (
  SELECT string_agg(label, ', ' ORDER BY label) AS labels
  FROM (SELECT DISTINCT label_text AS label FROM src
        WHERE split = 'train' AND label_text IS NOT NULL AND label_text <> 'oos')
)"""


def _label_sets(spark, sf):
    """(train vocabulary, vocabulary of all prepared rows) from one narrow pass over split, label and a null test."""
    rows = R.drop_nulls_oos(fx.f1_raw_splits(spark, sf).withColumn("text", F.col("text").isNotNull().cast("string")))
    sets = rows.groupBy("label_text").agg(F.bool_or(F.col("split") == "train").alias("train"),
                                          F.bool_or(F.col("text") == "true").alias("prepared")).collect()
    return sorted(r[0] for r in sets if r["train"]), sorted(r[0] for r in sets if r["prepared"])


def _train_labels(spark, sf):
    return _label_sets(spark, sf)[0]


def _records(spark, sf, labels=None):
    return R.prepare_records(fx.f1_raw_splits(spark, sf), _train_labels(spark, sf) if labels is None else labels)


def _flat(spark, sf):
    # the flattened columns don't spell the vocabulary out
    return R.flatten_records(_records(spark, sf, labels=[]))


@register("prepare_records", O.with_(_PREP_SQL) + """
SELECT example_id, split, utterance, label,
  'You are an intent classifier. Output exactly one intent label from the allowed label set. Do not explain your answer.'
    AS system_content,
  'Utterance: "' || utterance || '"' || chr(10) || 'Allowed labels: ' || labels AS user_content,
  label AS assistant_content
FROM prep, lv""")
def prepare_records(spark, sf):
    r = _records(spark, sf)
    return r.select("example_id", "meta.split", "meta.utterance", "meta.label",
                    F.col("messages")[0]["content"].alias("system_content"),
                    F.col("messages")[1]["content"].alias("user_content"),
                    F.col("messages")[2]["content"].alias("assistant_content"))


@register("flattened_split", O.with_(_PREP_SQL) + "\nSELECT example_id, utterance, label, split FROM prep")
def flattened_split(spark, sf):
    return _flat(spark, sf)


@register("drop_nulls_oos", O.with_(O.F1_CTE) + """
SELECT example_id, split, label_text FROM src
WHERE text IS NOT NULL AND label_text IS NOT NULL AND label_text <> 'oos'""")
def drop_nulls_oos(spark, sf):
    return R.drop_nulls_oos(fx.f1_raw_splits(spark, sf)).select("example_id", "split", "label_text")


@register("split_rename", O.with_(O.F1_CTE) + """
SELECT example_id, CASE split WHEN 'validation' THEN 'val' ELSE split END AS split FROM src""")
def split_rename(spark, sf):
    return fx.f1_raw_splits(spark, sf).select("example_id", R.rename_split(F.col("split")).alias("split"))


@register("nonblank_rows", O.with_(O.F1_CTE) + """
SELECT example_id, trim(coalesce(text, '')) AS utterance, trim(coalesce(label_text, '')) AS label FROM src
WHERE length(trim(coalesce(text, ''))) > 0 AND length(trim(coalesce(label_text, ''))) > 0""")
def nonblank_rows(spark, sf):
    raw = fx.f1_raw_splits(spark, sf)
    return R.nonblank_rows(raw, F.col("text"), F.col("label_text"), keep=("example_id",))


# --- prompts --------------------------------------------------------------------------------

_LANG_LABELS_SQL = """
ll AS (SELECT string_agg(lang, ', ' ORDER BY lang) AS labels FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL))"""


@register("user_prompt", O.with_(_LANG_LABELS_SQL) + """
SELECT doc_id AS example_id, 'Utterance: "' || trim(text) || '"' || chr(10) || 'Allowed labels: ' || labels AS prompt
FROM documents, ll""")
def user_prompt(spark, sf):
    d = fx.table(spark, sf, "documents")
    labels = V.collect_labels(d.select(F.col("lang").alias("label")))
    return d.select(F.col("doc_id").alias("example_id"), chat.user_prompt("text", labels).alias("prompt"))


_ZS_SYSTEM_SQL = """'You are an intent classifier. Choose exactly one label from the allowed labels. Reply with exactly one label from the allowed labels. Do not explain. Do not add any other words.' || chr(10) || 'Allowed labels: ' || labels"""


@register("zero_shot_prompt", O.with_(_PREP_SQL) + f"""
SELECT example_id,
  'SYSTEM: ' || {_ZS_SYSTEM_SQL} || {NL2} || 'USER: Utterance: "' || utterance || '"' || {NL2} || 'ASSISTANT:' AS prompt
FROM prep, lv""")
def zero_shot_prompt(spark, sf):
    labels = _label_sets(spark, sf)[1]
    flat = _flat(spark, sf)
    return flat.select("example_id", chat.render_upper(chat.zero_shot_messages("utterance", labels)).alias("prompt"))


_SUPPORT_SQL = """
sup AS (
  SELECT example_id, label, utterance, rn FROM (
    SELECT example_id, label, utterance, row_number() OVER (PARTITION BY label ORDER BY example_id) AS rn
    FROM prep WHERE split = 'train')
  WHERE rn <= 4 ORDER BY rn, label LIMIT 4
)"""


@register("few_shot_prompt", O.with_(_PREP_SQL, _SUPPORT_SQL, f"""
supt AS (
  SELECT string_agg('USER: Utterance: "' || utterance || '"' || {NL2} || 'ASSISTANT: ' || label, {NL2}
                    ORDER BY rn, label) AS txt FROM sup
)""") + f"""
SELECT example_id,
  'SYSTEM: ' || {_ZS_SYSTEM_SQL} || {NL2} || txt || {NL2} ||
  'USER: Utterance: "' || utterance || '"' || {NL2} || 'ASSISTANT:' AS prompt
FROM prep, lv, supt""")
def few_shot_prompt(spark, sf):
    labels = _label_sets(spark, sf)[1]
    flat = _flat(spark, sf)
    support = S.collect_support(S.few_shot_support(flat.where(F.col("split") == "train"), n=4), n=4)
    msgs = chat.few_shot_messages("utterance", labels, support)
    return flat.select("example_id", chat.render_upper(msgs).alias("prompt"))


@register("inference_prompt", O.with_(_PREP_SQL) + f"""
SELECT example_id,
  'System: You are an intent classifier. Choose exactly one label from the allowed labels. Output only the label and nothing else.' || {NL2} || 'User: Utterance: "' || utterance || '"' || chr(10) ||
  'Allowed labels: ' || labels || {NL2} || 'Assistant:' AS prompt
FROM prep, lv""")
def inference_prompt(spark, sf):
    labels = _label_sets(spark, sf)[1]
    flat = _flat(spark, sf)
    return flat.select("example_id", chat.inference_prompt("utterance", labels).alias("prompt"))


@register("utterance_from_messages", O.with_(_PREP_SQL) + """
SELECT example_id,
  CASE WHEN example_id % 2 = 0 THEN utterance
       WHEN regexp_matches(u, '(?s)Utterance:\\s*"(.*?)"') THEN regexp_extract(u, '(?s)Utterance:\\s*"(.*?)"', 1)
       ELSE u END AS utterance
FROM (SELECT example_id, utterance,
        'Utterance: "' || utterance || '"' || chr(10) || 'Allowed labels: ' || labels AS u FROM prep, lv)""")
def utterance_from_messages(spark, sf):
    r = _records(spark, sf)
    meta_utt = F.when(F.col("example_id") % 2 == 0, F.col("meta.utterance"))
    return r.select("example_id", chat.utterance_from_record("messages", meta_utt).alias("utterance"))


# --- conversations ------------------------------------------------------------------------

@register("first_user_content", """
SELECT conv_id, coalesce(arg_min(text, turn) FILTER (WHERE role = 'user'), '') AS utterance
FROM conversations GROUP BY conv_id""")
def first_user_content(spark, sf):
    return R.first_user_text(fx.table(spark, sf, "conversations"))


@register("utterance_from_conversations", """
SELECT conv_id, CASE WHEN u IS NULL THEN ''
  WHEN regexp_matches(u, '(?s)Utterance:\\s*"(.*?)"') THEN regexp_extract(u, '(?s)Utterance:\\s*"(.*?)"', 1)
  ELSE u END AS utterance
FROM (SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS u FROM conversations GROUP BY conv_id)""")
def utterance_from_conversations(spark, sf):
    first = R.first_user_text(fx.table(spark, sf, "conversations"))
    u = F.col("utterance")
    return first.select("conv_id", F.when(u.rlike(chat.UTTERANCE_RE), F.regexp_extract(u, chat.UTTERANCE_RE, 1))
                        .otherwise(u).alias("utterance"))


@register("drop_assistant", """
SELECT conv_id, turn, role FROM conversations WHERE role IS DISTINCT FROM 'assistant'""")
def drop_assistant(spark, sf):
    return R.drop_assistant_turns(fx.table(spark, sf, "conversations")).select("conv_id", "turn", "role")


@register("flatten_until_assistant", f"""
WITH fa AS (SELECT conv_id, min(turn) FILTER (WHERE role = 'assistant') AS fa FROM conversations GROUP BY conv_id)
SELECT c.conv_id,
  coalesce(string_agg(upper(left(trim(c.role), 1)) || lower(substr(trim(c.role), 2)) || ': ' || coalesce(c.text, ''),
                      {NL2} ORDER BY c.turn) FILTER (WHERE fa.fa IS NULL OR c.turn < fa.fa) || {NL2}, '')
    || 'Assistant:' AS prompt
FROM conversations c JOIN fa USING (conv_id) GROUP BY c.conv_id""")
def flatten_until_assistant(spark, sf):
    turns = fx.table(spark, sf, "conversations")
    return R.render_turns(turns, style="until_assistant")


@register("render_upper", f"""
SELECT conv_id, string_agg(upper(role) || ': ' || text, {NL2} ORDER BY turn) || {NL2} || 'ASSISTANT:' AS prompt
FROM conversations GROUP BY conv_id""")
def render_upper(spark, sf):
    return R.render_turns(fx.table(spark, sf, "conversations"), style="upper")


@register("trainable_turns", """
SELECT conv_id, turn, role, coalesce(role = 'assistant', FALSE) AS is_target
FROM conversations""")
def trainable_turns(spark, sf):
    return R.turn_targets(fx.table(spark, sf, "conversations")).select("conv_id", "turn", "role", "is_target")


# --- sampling -------------------------------------------------------------------------------

@register("few_shot_support", O.with_(_PREP_SQL, _SUPPORT_SQL) + """
SELECT example_id, label, utterance, CAST(rn - 1 AS INTEGER) AS round FROM sup""")
def few_shot_support(spark, sf):
    flat = _flat(spark, sf).where(F.col("split") == "train")
    return S.few_shot_support(flat, n=4)


@register("examples_by_label", O.with_(_PREP_SQL) + """
SELECT example_id, utterance, label,
  CAST(row_number() OVER (PARTITION BY label ORDER BY example_id) - 1 AS BIGINT) AS position
FROM prep""")
def examples_by_label(spark, sf):
    return S.examples_by_label(_flat(spark, sf))


@register("first_n_rows", O.with_(_PREP_SQL) + """
SELECT example_id, utterance, label, split FROM prep ORDER BY example_id LIMIT 50""")
def first_n_rows(spark, sf):
    return S.first_n_rows(_flat(spark, sf), 50)


@register("split_counts", O.with_(_PREP_SQL) + """
SELECT split, count(*) AS n_rows, count(DISTINCT label) AS n_labels FROM prep GROUP BY split""")
def split_counts(spark, sf):
    return S.split_counts(_flat(spark, sf))


@register("stratified_split", O.with_(_PREP_SQL, """
b AS (SELECT example_id, label, md5('42' || '|' || CAST(example_id AS VARCHAR)) AS h FROM prep WHERE split = 'train'),
c AS (SELECT label, count(*) AS n FROM b GROUP BY label),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, example_id) - 1 AS pos FROM b)""") + """
SELECT r.example_id, r.label,
  CASE WHEN pos < round(CAST(0.1 AS DOUBLE) * n) THEN 'validation' ELSE 'train' END AS assigned
FROM r JOIN c USING (label)""")
def stratified_split(spark, sf):
    train = _flat(spark, sf).where(F.col("split") == "train").select("example_id", "label")
    return S.stratified_split(train, test_size=0.1, seed=42)


@register("stratified_split_total", O.with_(_PREP_SQL, """
b AS (SELECT example_id, label, md5('42' || '|' || CAST(example_id AS VARCHAR)) AS h FROM prep WHERE split = 'train'),
c AS (SELECT label, count(*) AS n, CAST(count(*) * 15 // 100 AS BIGINT) AS whole, count(*) * 15 % 100 AS rest FROM b GROUP BY label),
q AS (
  SELECT label, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, n DESC, label)
    <= (SELECT floor((sum(n) * 15 + 50) / 100) - sum(whole) FROM c) THEN 1 ELSE 0 END AS quota FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, example_id) - 1 AS pos FROM b)""") + """
SELECT r.example_id, r.label, CASE WHEN pos < quota THEN 'validation' ELSE 'train' END AS assigned
FROM r JOIN q USING (label)""")
def stratified_split_total(spark, sf):
    """W03 with largest remainders: exactly round(15 %) of all rows, and each label within a row of its share."""
    train = _flat(spark, sf).where(F.col("split") == "train").select("example_id", "label")
    return S.stratified_split(train, test_size=0.15, seed=42, quota="round")
