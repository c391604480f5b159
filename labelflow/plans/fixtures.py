"""Derived relations the registered queries run on (FIXTURES.md F1-F5).

Each is a narrow projection of a driver table: no shuffle, and it grows with
the table. The modulo expressions decide labels and splits, they never drop rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.sources.tables import table

# Function words per language for guesser B (FIXTURES.md F2).
FUNCTION_WORDS = {
    "de": ("der", "die", "und", "das"),
    "en": ("the", "and", "of"),
    "es": ("el", "los", "y", "que"),
    "fr": ("le", "la", "et", "les"),
}
# Token delimiters of guesser B: space, dot, comma, newline.
GUESS_SPLIT = "[ .,\n]+"


def _mod(c: str, m: int) -> Column:
    return (F.col(c) % m) == 0


def guess_a(doc_id="doc_id", lang="lang") -> Column:
    return F.when(_mod(doc_id, 7), "xx").when(_mod(doc_id, 5), "fr").otherwise(F.col(lang))


def guess_c(doc_id="doc_id", lang="lang") -> Column:
    return F.when(_mod(doc_id, 3), "xx").when(_mod(doc_id, 11), "en").otherwise(F.col(lang))


def guess_d(doc_id="doc_id", lang="lang") -> Column:
    return F.when(_mod(doc_id, 4), "de").when(_mod(doc_id, 9), "xx").otherwise(F.col(lang))


def guess_language(text="text") -> Column:
    """Language whose function words occur most among the tokens of ``lower(text)`` split on
    GUESS_SPLIT; ties alphabetical; 'none' without hits.

    A token equals a word exactly when the word sits between delimiters (or the
    text's ends). One case-insensitive regex pass over the original text pulls
    out just those tokens (the word lists are ASCII, so ASCII case folding is the
    same as lowering the text first); the four counts then scan that short
    string. Each count is folded with its tie rank into one number
    (count * 4 + rank) so ``greatest`` evaluates every count once.
    """
    langs = sorted(FUNCTION_WORDS)              # de, en, es, fr: earlier wins ties
    every = "|".join(w for lang in langs for w in FUNCTION_WORDS[lang])
    hits = F.lower(F.array_join(
        F.regexp_extract_all(F.col(text), F.lit(f"(?i)(?<![^ .,\n])({every})(?![^ .,\n])"), F.lit(1)), " "))
    keyed = []
    for i, lang in enumerate(langs):
        words = "|".join(FUNCTION_WORDS[lang])
        n = F.coalesce(F.regexp_count(hits, F.lit(f"(?<![^ ])(?:{words})(?![^ ])")), F.lit(0))
        keyed.append(n * 4 + (len(langs) - 1 - i))
    best = F.greatest(*keyed)
    by_rank = F.array(*[F.lit(x) for x in reversed(langs)])   # rank r -> element r + 1
    return F.when(best < 4, F.lit("none")).otherwise(F.element_at(by_rank, (best % 4 + 1).cast("int")))


def f1_columns() -> dict[str, Column]:
    """F1's derived columns as expressions over documents (split, text, label_text)."""
    return {
        "split": F.when(_mod("doc_id", 10), "validation").when((F.col("doc_id") % 10) == 1, "test")
                  .otherwise("train"),
        "text": F.when(_mod("doc_id", 17), F.lit(None).cast("string")).otherwise(F.col("text")),
        "label_text": F.when(_mod("doc_id", 19), F.lit(None).cast("string")).when(_mod("doc_id", 13), "oos")
                       .otherwise(F.col("lang")),
    }


def f1_raw_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(example_id, split, text, label_text) with NULL texts/labels and 'oos' rows."""
    d = table(spark, sf_dir, "documents")
    c = f1_columns()
    return d.select(F.col("doc_id").alias("example_id"), c["split"].alias("split"), c["text"].alias("text"),
                    c["label_text"].alias("label_text"))


def f2_predictions(spark: SparkSession, sf_dir: str, guesser: str = "a") -> DataFrame:
    """(example_id, utterance, gold_label, predicted_label) for one guesser."""
    d = table(spark, sf_dir, "documents")
    pred = {"a": guess_a(), "b": guess_language(), "c": guess_c(), "d": guess_d()}[guesser]
    return d.select(F.col("doc_id").alias("example_id"), F.col("text").alias("utterance"),
                    F.col("lang").alias("gold_label"), pred.alias("predicted_label"))


def f2_stacked(spark: SparkSession, sf_dir: str, guessers=("a", "b")) -> DataFrame:
    """F2 with several guessers stacked, keyed by model_name (and mode).

    The guesses are computed in a projection first; the explode then only
    copies column references.
    """
    d = table(spark, sf_dir, "documents")
    preds = {"a": guess_a(), "b": guess_language(), "c": guess_c(), "d": guess_d()}
    mode = {"a": "zero-shot", "b": "few-shot", "c": "zero-shot", "d": "few-shot"}
    wide = d.select(F.col("doc_id").alias("example_id"), F.col("lang").alias("gold_label"),
                    *[preds[g].alias(f"_p_{g}") for g in guessers])
    arr = F.array(*[F.struct(F.lit(f"guesser_{g}").alias("model_name"), F.lit(mode[g]).alias("mode"),
                             F.col(f"_p_{g}").alias("predicted_label")) for g in guessers])
    return (wide.select("example_id", "gold_label", F.explode(arr).alias("m"))
            .select("example_id", "gold_label", "m.model_name", "m.mode", "m.predicted_label"))


def f3_raw_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(example_id, gold_label, raw_prediction) with twelve kinds of model text."""
    d = table(spark, sf_dir, "documents")
    lab = F.col("source")
    k = F.col("doc_id") % 12
    nl = F.lit("\n")
    raw = (F.when(k == 0, lab)
           .when(k == 1, F.concat(F.lit('"'), lab, F.lit('"')))
           .when(k == 2, F.upper(lab))
           .when(k == 3, F.concat(F.lit("  "), lab, F.lit("  ")))
           .when(k == 4, F.concat(lab, nl, F.lit("more words here")))
           .when(k == 5, F.concat(F.lit("label: "), lab, F.lit(", sure")))
           .when(k == 6, F.concat(F.lit("the intent is "), lab, F.lit(".")))
           .when(k == 7, F.concat(F.lit("assistant"), nl, nl, lab))
           .when(k == 8, F.lit(""))
           .when(k == 9, F.lit("unknown"))
           .when(k == 10, F.lit("src1"))
           .otherwise(F.concat(F.lit("'"), lab, F.lit("'"))))
    return d.select(F.col("doc_id").alias("example_id"), lab.alias("gold_label"),
                    raw.alias("raw_prediction"))


def f5_lineitem_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """return-flag pairs over the whole lineitem table."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias("gold_label"),
                     F.when(_mod("l_orderkey", 4), "N").otherwise(F.col("l_returnflag"))
                      .alias("predicted_label"))


def f4_loss_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 loss rows: run = user_id, order = (ts, event_id), loss NULL when event_id % 6 = 0,
    progress = row number / rows of the run (row numbers from the skew-safe ordinal)."""
    from labelflow.operators.sampling import group_ordinal

    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), "event_id", "ts",
        F.when(_mod("event_id", 6), F.lit(None).cast("double")).otherwise(F.col("value")).alias("train_mean_nll"))
    pos = group_ordinal(ev, "run", ["ts", "event_id"], out="_pos", total="_n")
    return (pos
            .select("run", "event_id", "ts", "train_mean_nll",
                    ((F.col("_pos") + 1) / F.col("_n")).alias("progress")))


# Per-run, per-epoch error moduli of the epoch fixture (F4 analogue on documents):
# run a plateaus then recovers, b has one bad epoch, c ties then falls.
EPOCH_MODULI = (("a", 1, 2), ("a", 2, 3), ("a", 3, 3), ("a", 4, 2), ("a", 5, 5),
                ("b", 1, 3), ("b", 2, 2), ("b", 3, 4),
                ("c", 1, 5), ("c", 2, 6), ("c", 3, 2))


def f4_epoch_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (run, epoch) predictions over all documents: 'xx' when doc_id % modulus = 0, else the gold."""
    d = table(spark, sf_dir, "documents")
    params = F.array(*[F.struct(F.lit(r).alias("run"), F.lit(e).alias("epoch"), F.lit(m).alias("m"))
                       for r, e, m in EPOCH_MODULI])
    x = d.select("doc_id", "lang", F.explode(params).alias("p"))
    return x.select("p.run", "p.epoch", F.col("lang").alias("gold_label"),
                    F.when((F.col("doc_id") % F.col("p.m")) == 0, F.lit("xx")).otherwise(F.col("lang"))
                     .alias("predicted_label"))
