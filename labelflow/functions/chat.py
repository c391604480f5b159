"""Chat records, messages and prompt strings as column expressions.

A message is ``struct<role: string, content: string>``; a conversation is an
array of them. All builders are JVM expressions (``concat``, ``transform``,
``filter``, ``array_join``), so prompt construction stays in whole-stage code
next to the scan. The label list enters as one literal string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelflow.functions.text import _c, capitalize, py_strip

# Prompt wording that must equal the reference's, verbatim.
SYSTEM_PROMPT = (
    "You are an intent classifier. "
    "Output exactly one intent label from the allowed label set. "
    "Do not explain your answer."
)
ZERO_SHOT_SYSTEM = (
    "You are an intent classifier. "
    "Choose exactly one label from the allowed labels. "
    "Reply with exactly one label from the allowed labels. "
    "Do not explain. Do not add any other words.\n"
    "Allowed labels: "
)
DEMO_SYSTEM = (
    "You are an intent classifier. "
    "Choose exactly one label from the allowed labels. "
    "Reply with exactly one label. Do not explain.\n"
    "Allowed labels: "
)
INFERENCE_SYSTEM = (
    "System: You are an intent classifier. "
    "Choose exactly one label from the allowed labels. "
    "Output only the label and nothing else.\n\n"
)
UTTERANCE_RE = r'(?s)Utterance:\s*"(.*?)"'

MESSAGE_TYPE = "struct<role:string,content:string>"


def message(role, content) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.alias("role"), _c(content).alias("content"))


def label_list_text(labels: Sequence[str], sort: bool = True) -> str:
    return ", ".join(sorted(labels) if sort else list(labels))


def quoted_utterance(utterance, strip: bool = False) -> Column:
    u = _c(utterance)
    return F.concat(F.lit('Utterance: "'), py_strip(u) if strip else u, F.lit('"'))


def user_prompt(utterance, labels: Sequence[str] | None = None, include_label_list: bool = True) -> Column:
    """``Utterance: "<stripped>"`` then ``\\nAllowed labels: a, b`` (sorted)."""
    base = quoted_utterance(utterance, strip=True)
    if include_label_list and labels is not None:
        return F.concat(base, F.lit("\nAllowed labels: " + label_list_text(labels)))
    return base


def chat_example(utterance, label, split, labels: Sequence[str], include_label_list: bool = True) -> Column:
    """Training record: system, user, assistant(label) messages plus ``meta``."""
    msgs = F.array(message("system", F.lit(SYSTEM_PROMPT)),
                   message("user", user_prompt(utterance, labels, include_label_list)),
                   message("assistant", _c(label)))
    meta = F.struct(_c(utterance).alias("utterance"), _c(label).alias("label"), _c(split).alias("split"))
    return F.struct(msgs.alias("messages"), meta.alias("meta"))


def zero_shot_messages(utterance, labels: Sequence[str], wording: str = "batch") -> Column:
    """System message carrying the label list, then the user utterance."""
    head = ZERO_SHOT_SYSTEM if wording == "batch" else DEMO_SYSTEM
    return F.array(message("system", F.lit(head + label_list_text(labels, sort=False))),
                   message("user", quoted_utterance(utterance)))


def few_shot_messages(utterance, labels: Sequence[str], support: Sequence[tuple[str, str]],
                      wording: str = "batch") -> Column:
    """System, one user/assistant pair per support example, then the query.

    ``support`` is the small (utterance, label) list chosen by
    ``labelflow.operators.sampling.few_shot_support``.
    """
    head = ZERO_SHOT_SYSTEM if wording == "batch" else DEMO_SYSTEM
    msgs = [message("system", F.lit(head + label_list_text(labels, sort=False)))]
    for utt, lab in support:
        msgs.append(message("user", F.lit(f'Utterance: "{utt}"')))
        msgs.append(message("assistant", F.lit((lab or "").strip())))
    msgs.append(message("user", quoted_utterance(utterance)))
    return F.array(*msgs)


def inference_prompt(utterance, labels: Sequence[str]) -> Column:
    """Single-string System/User/Assistant prompt."""
    return F.concat(F.lit(INFERENCE_SYSTEM + "User: "), quoted_utterance(utterance),
                    F.lit("\nAllowed labels: " + label_list_text(labels, sort=False) + "\n\nAssistant:"))


def render_upper(messages) -> Column:
    """``ROLE: content`` for every turn, then ``ASSISTANT:``, joined by blank lines."""
    parts = F.transform(_c(messages), lambda m: F.concat(F.upper(m["role"]), F.lit(": "), m["content"]))
    return F.array_join(F.concat(parts, F.array(F.lit("ASSISTANT:"))), "\n\n")


def until_first_assistant(messages) -> Column:
    """Messages before the first assistant turn (all of them if there is none)."""
    msgs = _c(messages)
    pos = F.array_position(F.transform(msgs, lambda m: m["role"]), "assistant")
    return F.when(pos == 0, msgs).otherwise(F.slice(msgs, 1, (pos - 1).cast("int")))


def flatten_until_assistant(messages) -> Column:
    """``Role: content`` blocks up to the first assistant turn, then ``Assistant:``."""
    head = until_first_assistant(messages)
    parts = F.transform(head, lambda m: F.concat(capitalize(py_strip(F.coalesce(m["role"], F.lit("")))),
                                                 F.lit(": "), F.coalesce(m["content"], F.lit(""))))
    return F.array_join(F.concat(parts, F.array(F.lit("Assistant:"))), "\n\n")


def drop_assistant(messages) -> Column:
    """Every non-assistant turn, wherever the assistant turns are."""
    return F.filter(_c(messages), lambda m: ~F.coalesce(m["role"] == "assistant", F.lit(False)))


def first_user_content(messages) -> Column:
    """Content of the first ``user`` turn, ``''`` if none (P10)."""
    first = F.get(F.filter(_c(messages), lambda m: m["role"] == "user"), 0)
    return F.coalesce(first["content"], F.lit(""))


def utterance_from_record(messages, meta_utterance=None) -> Column:
    """meta.utterance if present; else the quoted part of the first user turn, else its content; else '' (P09)."""
    first = F.get(F.filter(_c(messages), lambda m: m["role"] == "user"), 0)
    content = F.coalesce(first["content"], F.lit(""))
    from_user = F.when(first.isNull(), F.lit("")).when(
        content.rlike(UTTERANCE_RE), F.regexp_extract(content, UTTERANCE_RE, 1)).otherwise(content)
    if meta_utterance is None:
        return from_user
    return F.coalesce(_c(meta_utterance), from_user)


def mark_targets(messages) -> Column:
    """Flag the turns a trainer learns from: every assistant message (P20)."""
    return F.transform(_c(messages), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"),
                                                         (m["role"] == "assistant").alias("is_target")))
