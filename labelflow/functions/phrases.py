"""Labels of several words in text, found by their token sequences.

A text is cut into runs: maximal sequences of word characters, and of the characters between
them. A label occurs between word boundaries exactly where its own runs equal
neighbouring whole runs of the text; a label that starts or ends with separators must have a word
on that side. So no label needs a pattern of its own: windows of as many runs as some label
has, starting at a run that starts some label, are looked up in hashed sets.

Only the first token decides where a window is cut, so a text costs a lookup for each of its
runs and each number of runs that labels have, however many labels there are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word characters as Python's re has them: letters, numbers of any kind and the underscore.
WORD = r"\p{L}\p{N}_"
RUNS = rf"([{WORD}]+|[^{WORD}]+)"
_PY_RUNS = re.compile(r"\w+|\W+")


def runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(RUNS), F.lit(1))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def windows(parts: Column, size: int, firsts: Callable[[Column], Column] | None = None) -> Column:
    """Distinct phrases of ``size`` neighbouring runs that could be a label's whole occurrence.

    ``firsts`` tells whether a run starts some label of that size. A window that starts (ends) with
    separators is left out at the start (end) of the text.
    """
    n = F.size(parts)

    def fits(i: Column) -> Column:
        first, last = F.get(parts, i), F.get(parts, i + (size - 1))
        ok = ((i > 0) | first.rlike(rf"^[{WORD}]")) & ((i + size < n) | last.rlike(rf"^[{WORD}]"))
        return ok if firsts is None else firsts(first) & ok

    starts = F.filter(F.sequence(F.lit(0), n - size), fits)
    text = (lambda i: F.get(parts, i)) if size == 1 else (lambda i: F.array_join(F.slice(parts, i + 1, size), ""))
    return F.when(n >= size, F.array_distinct(F.transform(starts, text))).otherwise(F.array().cast("array<string>"))


def occurrences(rows: DataFrame, key: str, text: str, labels: DataFrame, label: str, most_bytes: int) -> DataFrame:
    """(key, label): a row for each place of a text whose runs could be one of ``labels``, a table.

    The plan form of ``windows``: runs are generated as rows that never leave the task and are tested in
    compiled code, where a function over arrays would be interpreted run by run. The first runs of the
    labels, with the numbers of runs that follow them, are broadcast if they take up to ``most_bytes``, so a phrase is put
    together only where some label could start; beyond, wherever a word or separator begins.
    """
    cut = labels.where(F.col(label) != "").select(runs(F.col(label)).alias("_runs"))
    heads = cut.select(F.get("_runs", F.lit(0)).alias("_first"), F.size("_runs").alias("_size")).distinct()
    # the first generator keeps the runs from being cut again for every use below
    texts = rows.select(key, F.explode(F.array(runs(F.col(text)))).alias("_runs"))
    at = texts.select(key, "_runs", F.posexplode("_runs").alias("_i", "_first"))
    taken = heads.agg(F.sum(F.octet_length("_first") + 64)).first()[0] or 0
    if taken <= most_bytes:
        at = at.join(F.broadcast(heads), "_first")
    else:
        sizes = [r[0] for r in heads.select("_size").distinct().collect()]
        at = at.select("*", F.explode(F.array(*[F.lit(n) for n in sorted(sizes)])).alias("_size"))
    n, i, size = F.size("_runs"), F.col("_i"), F.col("_size")
    last = F.get("_runs", i + size - 1)
    fits = (i + size <= n) & ((i > 0) | F.col("_first").rlike(rf"^[{WORD}]")) & ((i + size < n) | last.rlike(rf"^[{WORD}]"))
    return at.where(fits).select(key, F.array_join(F.slice("_runs", i + 1, size), "").alias(label))


def among(values: list[str]) -> Callable[[Column], Column]:
    """Membership in a set that the optimizer hashes."""
    return lambda x: x.isin(*values)


class PhraseIndex:
    """A trie of given labels by their runs: first runs by number of runs, and the phrases themselves."""

    def __init__(self, labels: Iterable[str]):
        self.by_size: dict[int, tuple[list[str], list[str]]] = {}
        found: dict[int, tuple[set, set]] = {}
        for label in labels:
            if not label:
                continue
            cut = _PY_RUNS.findall(label)
            heads, phrases = found.setdefault(len(cut), (set(), set()))
            heads.add(cut[0])
            phrases.add(label)
        for size, (heads, phrases) in sorted(found.items()):
            self.by_size[size] = sorted(heads), sorted(phrases)

    def occurring(self, text: Column) -> Column:
        """The labels (as given) that occur in ``text``; an array, null for a null text."""
        if not self.by_size:
            return F.when(text.isNotNull(), F.array().cast("array<string>"))

        def look(parts: Column) -> Column:
            found = [F.filter(windows(parts, size, among(heads)), among(phrases)) for size, (heads, phrases) in self.by_size.items()]
            return found[0] if len(found) == 1 else F.concat(*found)

        return F.when(text.isNotNull(), bound(runs(text), look))
