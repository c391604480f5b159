"""Raw labelled splits -> chat training records.

Preparation is one narrow projection per row; only the vocabulary (a distinct
over the train split) aggregates, and it is passed in as a size-checked list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.functions import chat
from labelflow.functions.text import normalize_ws, py_strip

# Split names as written by the reference.
SPLIT_NAMES = {"train": "train", "validation": "val", "test": "test"}


def rename_split(split: Column) -> Column:
    """``validation`` -> ``val``; other names unchanged."""
    out = None
    for src, dst in SPLIT_NAMES.items():
        out = (F.when(split == src, F.lit(dst)) if out is None else out.when(split == src, F.lit(dst)))
    return out.otherwise(split)


def drop_nulls_oos(df: DataFrame, text: str = "text", label: str = "label_text",
                   include_oos: bool = False, oos_label: str = "oos") -> DataFrame:
    """Rows with text and label, out-of-scope rows dropped unless ``include_oos``."""
    kept = df.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    if not include_oos:
        kept = kept.where(F.col(label) != oos_label)
    return kept


def prepare_records(df: DataFrame, labels: Sequence[str], text: str = "text", label: str = "label_text",
                    split: str = "split", include_oos: bool = False, keep: Sequence[str] = ("example_id",),
                    include_label_list: bool = True) -> DataFrame:
    """Full split preparation: P01 -> P03 -> P02 -> P05 -> P07.

    Output: ``keep`` columns, ``messages`` array<struct<role,content>>, ``meta``
    struct<utterance,label,split>.
    """
    rows = drop_nulls_oos(df, text, label, include_oos)
    utt = normalize_ws(F.col(text))
    rec = chat.chat_example(utt, F.col(label).cast("string"), rename_split(F.col(split)), labels,
                            include_label_list)
    return rows.select(*keep, rec.alias("r")).select(*keep, "r.messages", "r.meta")


def flatten_records(records: DataFrame, keep: Sequence[str] = ("example_id",)) -> DataFrame:
    """``utterance, label, split`` of chat records (S05); Spark prunes the nested messages."""
    return records.select(*keep, "meta.utterance", "meta.label", "meta.split")


def nonblank_rows(df: DataFrame, utterance: Column, label: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Stripped utterance and label, rows where both are non-empty."""
    u = py_strip(F.coalesce(utterance, F.lit("")))
    lab = py_strip(F.coalesce(label, F.lit("")))
    return (df.select(*keep, u.alias("utterance"), lab.alias("label"))
            .where((F.length("utterance") > 0) & (F.length("label") > 0)))


def conversation_messages(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                          text: str = "text") -> DataFrame:
    """Turn rows -> one row per conversation with its ordered ``messages`` array.

    This gathers a conversation's turns into one row, so use it only where the
    result is one value per conversation (a rendered prompt, a chat record);
    the turn-level operators below never gather a conversation.
    """
    return (turns.groupBy(conv)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("role"),
                                                      F.col(text).alias("content")))).alias("_m"))
            .select(conv, F.transform("_m", lambda m: F.struct(m["role"].alias("role"),
                                                               m["content"].alias("content"))).alias("messages")))


# --- turn-level forms: no conversation is ever gathered into one row -------------------------

def turn_targets(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role") -> DataFrame:
    """Every turn with ``is_target`` = it is an assistant message (P20), one row per turn."""
    return turns.withColumn("is_target", F.coalesce(F.col(role) == "assistant", F.lit(False)))


def drop_assistant_turns(turns: DataFrame, role: str = "role") -> DataFrame:
    """The non-assistant turns, wherever the assistant turns are (P12), one row per turn."""
    return turns.where(~F.coalesce(F.col(role) == "assistant", F.lit(False)))


def turns_before_first_assistant(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                                 role: str = "role") -> DataFrame:
    """Turns before the first assistant turn of their conversation (all turns if none).

    The first assistant turn per conversation is a partial aggregate; joining it
    back lets Spark broadcast it or, for a huge table, AQE split a dominant
    conversation's partition.
    """
    first = (turns.groupBy(conv)
             .agg(F.min(F.when(F.col(role) == "assistant", F.col(turn))).alias("_first_assistant")))
    return (turns.join(first, conv)
            .where(F.col("_first_assistant").isNull() | (F.col(turn) < F.col("_first_assistant")))
            .drop("_first_assistant"))


def render_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", style: str = "until_assistant") -> DataFrame:
    """One prompt string per conversation (P13 ``until_assistant``, P14 ``upper``).

    A prompt is one value per conversation by definition; for P13 the turns are
    cut at the first assistant turn before they are gathered.
    """
    from labelflow.functions import chat

    if style == "until_assistant":
        kept = turns_before_first_assistant(turns, conv, turn, role)
        msgs = conversation_messages(kept, conv, turn, role, text)
        return msgs.select(conv, chat.flatten_until_assistant("messages").alias("prompt"))
    if style == "upper":
        msgs = conversation_messages(turns, conv, turn, role, text)
        return msgs.select(conv, chat.render_upper("messages").alias("prompt"))
    raise ValueError("style must be 'until_assistant' or 'upper'")


def first_user_text(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """Content of each conversation's first user turn, ``''`` if none (P10 on turn rows).

    ``min_by`` over user turns only: a partial aggregate, safe for a dominant conversation.
    """
    first = F.min_by(F.col(text), F.when(F.col(role) == "user", F.col(turn)))
    has_user = F.max(F.col(role) == "user")
    return (turns.groupBy(conv)
            .agg(F.when(F.coalesce(has_user, F.lit(False)), F.coalesce(first, F.lit(""))).otherwise(F.lit(""))
                 .alias("utterance")))
