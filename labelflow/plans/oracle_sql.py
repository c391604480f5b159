"""DuckDB twins of the fixtures and metric plans, used as the correctness oracle.

These strings are only read by the external checker (and by the repository's
own differential test); Spark never executes them.
"""

from __future__ import annotations

# The same function words and moduli as labelflow.plans.fixtures.
F2_GUESS_A = "CASE WHEN doc_id % 7 = 0 THEN 'xx' WHEN doc_id % 5 = 0 THEN 'fr' ELSE lang END"
F2_GUESS_C = "CASE WHEN doc_id % 3 = 0 THEN 'xx' WHEN doc_id % 11 = 0 THEN 'en' ELSE lang END"
F2_GUESS_D = "CASE WHEN doc_id % 4 = 0 THEN 'de' WHEN doc_id % 9 = 0 THEN 'xx' ELSE lang END"

F2_GUESS_B_CTE = r"""
gb_tok AS (
  SELECT doc_id, string_split_regex(lower(text), '[ .,\n]+') AS toks FROM documents
),
gb_cnt AS (
  SELECT doc_id,
    coalesce(len(list_filter(toks, lambda x: x IN ('der','die','und','das'))), 0) AS c_de,
    coalesce(len(list_filter(toks, lambda x: x IN ('the','and','of'))), 0) AS c_en,
    coalesce(len(list_filter(toks, lambda x: x IN ('el','los','y','que'))), 0) AS c_es,
    coalesce(len(list_filter(toks, lambda x: x IN ('le','la','et','les'))), 0) AS c_fr
  FROM gb_tok
),
guess_b AS (
  SELECT doc_id, CASE
    WHEN greatest(c_de, c_en, c_es, c_fr) <= 0 THEN 'none'
    WHEN c_de = greatest(c_de, c_en, c_es, c_fr) THEN 'de'
    WHEN c_en = greatest(c_de, c_en, c_es, c_fr) THEN 'en'
    WHEN c_es = greatest(c_de, c_en, c_es, c_fr) THEN 'es'
    ELSE 'fr' END AS guess
  FROM gb_cnt
)"""


def f2_cte(guesser: str = "a", name: str = "src") -> str:
    if guesser == "b":
        return (F2_GUESS_B_CTE + f""",
{name} AS (
  SELECT d.doc_id AS example_id, d.text AS utterance, d.lang AS gold_label, g.guess AS predicted_label
  FROM documents d JOIN guess_b g USING (doc_id)
)""")
    expr = {"a": F2_GUESS_A, "c": F2_GUESS_C, "d": F2_GUESS_D}[guesser]
    return f"""
{name} AS (
  SELECT doc_id AS example_id, text AS utterance, lang AS gold_label, {expr} AS predicted_label
  FROM documents
)"""


def f2_stacked_cte(guessers=("a", "b"), name: str = "src") -> str:
    mode = {"a": "zero-shot", "b": "few-shot", "c": "zero-shot", "d": "few-shot"}
    expr = {"a": F2_GUESS_A, "b": "g.guess", "c": F2_GUESS_C, "d": F2_GUESS_D}
    parts = []
    for g in guessers:
        parts.append(f"SELECT d.doc_id AS example_id, d.lang AS gold_label, 'guesser_{g}' AS model_name, "
                     f"'{mode[g]}' AS mode, {expr[g]} AS predicted_label "
                     f"FROM documents d JOIN guess_b g USING (doc_id)")
    return F2_GUESS_B_CTE + f",\n{name} AS (\n  " + "\n  UNION ALL\n  ".join(parts) + "\n)"


F1_CTE = """
src AS (
  SELECT doc_id AS example_id,
    CASE WHEN doc_id % 10 = 0 THEN 'validation' WHEN doc_id % 10 = 1 THEN 'test' ELSE 'train' END AS split,
    CASE WHEN doc_id % 17 = 0 THEN NULL ELSE text END AS text,
    CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'oos' ELSE lang END AS label_text
  FROM documents
)"""

F3_CTE = r"""
src AS (
  SELECT doc_id AS example_id, source AS gold_label,
    CASE doc_id % 12
      WHEN 0 THEN source
      WHEN 1 THEN '"' || source || '"'
      WHEN 2 THEN upper(source)
      WHEN 3 THEN '  ' || source || '  '
      WHEN 4 THEN source || chr(10) || 'more words here'
      WHEN 5 THEN 'label: ' || source || ', sure'
      WHEN 6 THEN 'the intent is ' || source || '.'
      WHEN 7 THEN 'assistant' || chr(10) || chr(10) || source
      WHEN 8 THEN ''
      WHEN 9 THEN 'unknown'
      WHEN 10 THEN 'src1'
      ELSE chr(39) || source || chr(39) END AS raw_prediction
  FROM documents
)"""

F5_CTE = """
src AS (
  SELECT l_returnflag AS gold_label,
    CASE WHEN l_orderkey % 4 = 0 THEN 'N' ELSE l_returnflag END AS predicted_label
  FROM lineitem
)"""


def _k(keys, trailing=True) -> str:
    if not keys:
        return ""
    s = ", ".join(keys)
    return s + ", " if trailing else s


def metric_ctes(keys=(), src: str = "src", gold: str = "gold_label", pred: str = "predicted_label") -> str:
    """pairs -> stats -> scores CTEs (no leading WITH, no leading comma)."""
    k = _k(keys)
    return f"""
pairs AS (
  SELECT {k}{gold} AS gold, coalesce({pred}, '') AS pred, count(*) AS cnt
  FROM {src} WHERE {gold} IS NOT NULL GROUP BY ALL
),
sides AS (
  SELECT {k}gold AS label, cnt AS s, 0 AS p, CASE WHEN gold = pred THEN cnt ELSE 0 END AS t FROM pairs
  UNION ALL
  SELECT {k}pred AS label, 0 AS s, cnt AS p, 0 AS t FROM pairs
),
stats AS (
  SELECT {k}label, CAST(sum(s) AS BIGINT) AS support, CAST(sum(p) AS BIGINT) AS predicted,
         CAST(sum(t) AS BIGINT) AS tp
  FROM sides GROUP BY ALL
),
scores AS (
  SELECT {k}label, tp, support,
    CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0.0 END AS recall,
    CASE WHEN support + predicted > 0 THEN (2 * tp)::DOUBLE / (support + predicted) ELSE 0.0 END AS f1_score
  FROM stats
)"""


def summary_sql(keys=(), universe: str = "union", d: int = 10) -> str:
    k = _k(keys)
    inside = "TRUE" if universe == "union" else "support > 0"
    grp = f" GROUP BY {_k(keys, False)}" if keys else ""
    return f"""SELECT {k}
  round(CASE WHEN sum(support) > 0 THEN sum(tp)::DOUBLE / sum(support) ELSE 0.0 END, {d}) AS accuracy,
  round(avg(CASE WHEN {inside} THEN f1_score END), {d}) AS macro_f1,
  CAST(sum(support) AS BIGINT) AS n_rows,
  CAST(count_if({inside}) AS BIGINT) AS n_labels
FROM scores{grp}"""


def per_label_sql(keys=(), d: int = 10) -> str:
    k = _k(keys)
    return f"""SELECT {k}label, round(precision, {d}) AS precision, round(recall, {d}) AS recall,
  round(f1_score, {d}) AS f1_score, support FROM scores"""


def full_report_sql(keys=(), d: int = 10) -> str:
    k = _k(keys)
    grp = f" GROUP BY {_k(keys, False)}" if keys else ""
    return f"""SELECT {k}'label' AS row_type, label, round(precision, {d}) AS precision, round(recall, {d}) AS recall,
  round(f1_score, {d}) AS f1_score, round(support::DOUBLE, {d}) AS support FROM scores
UNION ALL
SELECT {k}'accuracy', 'accuracy', round(a, {d}), round(a, {d}), round(a, {d}), round(a, {d})
FROM (SELECT {k}CASE WHEN sum(support) > 0 THEN sum(tp)::DOUBLE / sum(support) ELSE 0.0 END AS a
      FROM scores{grp})
UNION ALL
SELECT {k}'macro avg', 'macro avg', round(avg(precision), {d}), round(avg(recall), {d}),
  round(avg(f1_score), {d}), round(sum(support)::DOUBLE, {d}) FROM scores{grp}
UNION ALL
SELECT {k}'weighted avg', 'weighted avg',
  round(CASE WHEN sum(support) > 0 THEN sum(precision * support) / sum(support) ELSE 0.0 END, {d}),
  round(CASE WHEN sum(support) > 0 THEN sum(recall * support) / sum(support) ELSE 0.0 END, {d}),
  round(CASE WHEN sum(support) > 0 THEN sum(f1_score * support) / sum(support) ELSE 0.0 END, {d}),
  round(sum(support)::DOUBLE, {d}) FROM scores{grp}"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes if c.strip())
