"""Raw model text -> canonical label (X01-X06), as column expressions.

Every strategy is a projection: the label vocabulary enters the plan as
literals (a hashed IN-set for labels equal to their lowered form, a small map
for the rest), so extraction needs no join and no shuffle, and runs inside the
scan's stage. The vocabulary is a model parameter; callers obtain it with
``labelflow.operators.vocab.collect_labels``, or leave it in a table and call
``extract_label_join``, which gives the same labels.

The whole-word stage is rewritten from "one regex per label, longest first" to
"cut the text into runs, look up the windows that start like a label, keep the
longest label (ties alphabetical)", see ``labelflow.functions.phrases``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelflow.functions import phrases
from labelflow.functions.text import WS, _c, first_line, match_normalize, py_strip, strip_chars

STRATEGIES = ("first_line", "canonical", "strict", "cascade_plain", "cascade")
# The chunk separators of the cascade strategies (newline, comma, semicolon, colon).
CHUNK_SPLIT = r"[\n,;:]+"


#: Largest vocabulary, in bytes with 64 for each label, that a join on labels broadcasts.
BROADCAST_BYTES = 32 << 20


class _Resolver:
    """Lowered key -> canonical label with O(1) membership.

    Spark evaluates map lookups by scanning the keys, so a literal map costs
    O(labels) per lookup. Keys whose winning label is the key itself (the
    usual case: lower-case labels) are tested with ``isin``, which the
    optimizer turns into a hashed ``InSet``; only labels that differ from
    their lowered form go through a small literal map. For a duplicated key
    the first pair wins.
    """

    def __init__(self, pairs: list[tuple[str, str]]):
        seen: dict[str, str] = {}
        for k, v in pairs:
            seen.setdefault(k, v)
        self.same = [k for k, v in seen.items() if k == v]
        self.other = other = {k: v for k, v in seen.items() if k != v}
        self.map = (F.map_from_arrays(F.lit(list(other.keys())), F.lit(list(other.values())))
                    if other else None)

    def keys(self) -> list[str]:
        return [*self.same, *self.other]

    def get(self, key: Column) -> Column:
        parts = []
        if self.same:
            parts.append(F.when(key.isin(*self.same), key))
        if self.map is not None:
            parts.append(F.try_element_at(self.map, key))
        if not parts:
            return F.lit(None).cast("string")
        return parts[0] if len(parts) == 1 else F.coalesce(*parts)


def by_length(labels: Sequence[str]) -> list[str]:
    """Longest first, ties alphabetical (L03 with a total order)."""
    return sorted(set(labels), key=lambda x: (-len(x), x))


def _first_hit(arr: Column) -> Column:
    return F.get(F.filter(arr, lambda x: x.isNotNull()), 0)


def _strip_quotes(c: Column, quote_mode: str) -> Column:
    if quote_mode == "sequential":
        return strip_chars(strip_chars(c, '"'), "'")
    if quote_mode == "set":
        return strip_chars(c, "\"'")
    raise ValueError("quote_mode must be 'sequential' or 'set'")


def whole_word_label(text: Column, labels: Sequence[str]) -> Column:
    """Longest label (ties alphabetical) occurring as a whole word in ``text``.

    ``text`` is matched as given; labels are lowered, as in the reference.
    NULL when no label occurs.
    """
    m = _Resolver([(x.lower(), x) for x in by_length(labels)])
    found = phrases.PhraseIndex(m.keys()).occurring(text)
    hits = F.transform(found, lambda p: phrases.bound(m.get(p), lambda x: F.struct((-F.length(x)).alias("k"), x.alias("label"))))
    return F.array_min(hits).getField("label")


def extract_first_line(text) -> Column:
    """Strip, first line, strip ('' for empty text)."""
    return py_strip(first_line(py_strip(_c(text))))


def extract_canonical(text, labels: Sequence[str]) -> Column:
    """quote/space-stripped, lowered exact match; then its first line; else the stripped text."""
    t = _c(text)
    # dict comprehension semantics: for a duplicated lowered key the last label wins
    m = _Resolver([(x.lower(), x) for x in reversed(sorted(set(labels)))])
    cand = F.lower(py_strip(_strip_quotes(py_strip(t), "sequential")))
    line = py_strip(first_line(cand))
    return F.coalesce(m.get(cand), m.get(line), F.when(cand == "", F.lit("")), py_strip(t))


def extract_strict(text, labels: Sequence[str]) -> Column:
    """Normalised exact match; quote-stripped normalised match; else the cleaned text."""
    t = py_strip(_c(text))
    m = _Resolver([(x.lower(), x) for x in sorted(set(labels))])
    cleaned = py_strip(_strip_quotes(t, "sequential"))
    return F.coalesce(m.get(match_normalize(t)), m.get(match_normalize(cleaned)),
                      F.when(cleaned != "", cleaned), t)


def extract_cascade_plain(text, labels: Sequence[str]) -> Column:
    """Lowered exact; first chunk that is a label; longest whole word; else first line."""
    raw = _c(text)
    t = F.lower(py_strip(raw))
    m = _Resolver([(x.lower(), x) for x in by_length(labels)])
    chunk = _first_hit(F.transform(F.split(t, CHUNK_SPLIT), lambda c: m.get(py_strip(c))))
    stripped = py_strip(raw)
    fallback = F.when(stripped == "", F.lit("")).otherwise(py_strip(first_line(stripped)))
    return F.coalesce(m.get(t), chunk, whole_word_label(t, labels), fallback)


def extract_cascade(text, labels: Sequence[str], quote_mode: str = "sequential") -> Column:
    """Normalised exact; quote-stripped; per-chunk; longest whole word; else first line."""
    t = py_strip(_c(text))
    norm = match_normalize(t)
    m = _Resolver([(x.lower(), x) for x in sorted(set(labels))])
    if quote_mode == "sequential":
        cleaned = py_strip(_strip_quotes(t, quote_mode))
        chunk_key = lambda c: match_normalize(py_strip(_strip_quotes(py_strip(c), quote_mode)))
    else:
        cleaned = py_strip(_strip_quotes(t, quote_mode))
        chunk_key = lambda c: match_normalize(py_strip(_strip_quotes(c, quote_mode)))
    chunk = _first_hit(F.transform(F.split(t, CHUNK_SPLIT), lambda c: m.get(chunk_key(c))))
    fallback = F.when(t == "", F.lit("")).otherwise(py_strip(first_line(t)))
    return F.coalesce(m.get(norm), m.get(match_normalize(cleaned)), chunk,
                      whole_word_label(norm, labels), fallback)


def extract_label(text, labels: Sequence[str] | None = None, strategy: str = "cascade",
                  quote_mode: str = "sequential") -> Column:
    """Dispatch on ``strategy`` (one of STRATEGIES)."""
    if strategy == "first_line":
        return extract_first_line(text)
    if labels is None:
        raise ValueError(f"strategy {strategy!r} needs labels")
    if strategy == "canonical":
        return extract_canonical(text, labels)
    if strategy == "strict":
        return extract_strict(text, labels)
    if strategy == "cascade_plain":
        return extract_cascade_plain(text, labels)
    if strategy == "cascade":
        return extract_cascade(text, labels, quote_mode)
    raise ValueError(f"unknown strategy {strategy!r}; expected one of {STRATEGIES}")


# --- join-based path for vocabularies of any size ----------------------------------------------

def _strip_ends(c: Column) -> Column:
    """``py_strip`` that looks through the text only where an end has white space; ``c`` must be cheap to name again."""
    return F.when(F.left(c, F.lit(1)).rlike(rf"(?U){WS}") | F.right(c, F.lit(1)).rlike(rf"(?U){WS}"), py_strip(c)).otherwise(c)


def _stages(text: Column, strategy: str, quote_mode: str = "sequential", stripped: Column | None = None):
    """(candidate array<struct<p:int, s:int, k:string>>, whole-word text or None, fallback, dedupe)

    ``p`` is the stage priority, ``s`` the position inside the stage (first chunk wins),
    ``k`` the lowered lookup key; ``dedupe`` says which label wins a shared lowered key.
    ``stripped`` is the stripped text where a caller has it already.
    """
    stripped = py_strip(text) if stripped is None else stripped

    def one(p, k):
        return F.array(F.struct(F.lit(p).alias("p"), F.lit(0).alias("s"), k.alias("k")))

    def chunks(p, arr, fn):
        return F.transform(arr, lambda c, i: F.struct(F.lit(p).alias("p"), i.alias("s"), fn(c).alias("k")))

    if strategy == "canonical":
        t = text
        cand = F.lower(py_strip(_strip_quotes(py_strip(t), "sequential")))
        arr = F.concat(one(0, cand), one(1, py_strip(first_line(cand))))
        return arr, None, F.when(cand == "", F.lit("")).otherwise(py_strip(t)), "last"
    if strategy == "strict":
        t = py_strip(text)
        cleaned = py_strip(_strip_quotes(t, "sequential"))
        arr = F.concat(one(0, match_normalize(t)), one(1, match_normalize(cleaned)))
        return arr, None, F.coalesce(F.when(cleaned != "", cleaned), t), "first"
    if strategy == "cascade_plain":
        t = F.lower(stripped)
        arr = F.concat(one(0, t), chunks(1, F.split(t, CHUNK_SPLIT), _strip_ends))
        fb = F.when(stripped == "", F.lit("")).otherwise(py_strip(first_line(stripped)))
        return arr, t, fb, "length"
    if strategy == "cascade":
        t = stripped
        if quote_mode == "sequential":
            key = lambda c: match_normalize(py_strip(_strip_quotes(py_strip(c), quote_mode)))
        else:
            key = lambda c: match_normalize(py_strip(_strip_quotes(c, quote_mode)))
        cleaned = py_strip(_strip_quotes(t, quote_mode))
        arr = F.concat(one(0, match_normalize(t)), one(1, match_normalize(cleaned)),
                       chunks(2, F.split(t, CHUNK_SPLIT), key))
        fb = F.when(t == "", F.lit("")).otherwise(py_strip(first_line(t)))
        return arr, match_normalize(t), fb, "first"
    raise ValueError(f"strategy {strategy!r} has no join form")


def extract_label_join(df, key: str, text: str, vocab, strategy: str = "cascade",
                       out: str = "predicted_label", label: str = "label", quote_mode: str = "sequential"):
    """X02-X05 for any vocabulary size, by joins instead of an inlined map (exact, same results).

    Rows give their lookup keys with a priority, and the phrases of their text that could be a
    label (``phrases.occurrences``); both are joined with the vocabulary as narrow rows of (row key, phrase).
    One of at most BROADCAST_BYTES is read once and broadcast, so that only hits move; beyond, both sides
    are shuffled on the phrase, and AQE splits one that many rows share. The best hit per row is a min over
    (stage, position, label) with a partial aggregate, joined back by the row key, so a text moves at
    most once. ``df`` is read for keys, phrases and rows, each with the columns it needs: its keys must be the
    same each time. A null key gets no hit, rows that share a key share their hits.

    A phrase that joins is an occurrence, so nothing is looked for in the text again. The
    vocabulary's first runs and numbers of runs decide which phrases are cut.
    """
    t = F.col(text)
    fallback, dedupe = _stages(t, strategy, quote_mode)[2:]
    # the generator keeps the text from being stripped again for every use below
    stripped = df.select(F.col(key).alias("_key"), F.explode(F.array(_strip_ends(t))).alias("_t"))
    arr, words_text = _stages(F.col("_t"), strategy, quote_mode, F.col("_t"))[:2]
    v = vocab.select(F.col(label).alias("_label")).where(F.col("_label").isNotNull()).distinct()
    if dedupe == "last":
        agg = F.max("_label")
    elif dedupe == "length":
        agg = F.min_by("_label", F.struct(-F.length("_label"), F.col("_label")))
    else:
        agg = F.min("_label")
    keyed = v.groupBy(F.lower("_label").alias("_k")).agg(agg.alias("_label"))
    size = keyed.agg(F.sum(F.octet_length("_k") + F.octet_length("_label") + 64)).first()[0] or 0
    small = size <= BROADCAST_BYTES
    if small:
        keyed = df.sparkSession.createDataFrame(keyed.collect(), keyed.schema)
    lookup = F.broadcast(keyed) if small else keyed
    keys = stripped.select("_key", F.explode(arr).alias("_c")).select("_key", "_c.p", "_c.s", F.col("_c.k").alias("_k"))
    hits = keys.join(lookup, "_k").select("_key", F.struct("p", "s", "_label").alias("_hit"))
    if words_text is not None:
        found = phrases.occurrences(stripped.select("_key", words_text.alias("_t")), "_key", "_t", keyed.select("_k"), "_k", BROADCAST_BYTES)
        # inside the text the longest label is best
        hits = hits.unionByName(found.join(lookup, "_k").select(
            "_key", F.struct(F.lit(9).alias("p"), (-F.length("_label")).alias("s"), "_label").alias("_hit")))
    best = hits.groupBy("_key").agg(F.min("_hit")["_label"].alias("_best"))
    rows = df.select(*df.columns, F.col(key).alias("_key")).join(best, "_key", "left")
    return rows.select(*df.columns, F.when(t.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(F.col("_best"), fallback)).alias(out))
