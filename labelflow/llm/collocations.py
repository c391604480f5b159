"""Phrases whose words occur together more often than their parts suggest, from weighted automata.

Pieces of text are runs of words without punctuation between them; everything is counted per
language. A phrase of two or three words is a candidate if it occurs at least ``least`` times; it scores by
its weakest cut into two parts, a^2 / (l r). A candidate inside a longer one that is at least half as
frequent is dropped.

* A task numbers its words, sorts its n-grams as integers and builds count automata
  (``automata.Automaton``) from them, cut where the language's prefix ranges end.
* A prefix range holds all n-grams between two n-grams. The bounds come from a sample of n-grams;
  they decide only which task sums what. The automata of a range are united and their weights summed; n-grams below
  ``least`` end there, since no candidate and no part of one is rarer.
* Each range asks for the parts of its candidates: an automaton of the parts, weighted by the
  most frequent phrase that asks, goes to each range that holds some. There it is composed with the
  counts, which gives the parts' counts, and shows the candidates that a longer one absorbs.
* Scores are integers of any size in Python. A window with a group limit keeps the first rows of each language.

A word in every phrase is one arc in each task's automaton and one request from each range, so no key is
hot. A null language counts as ``und``; null and blank texts have no words. Repeated rows count each. An empty
table gives no rows. Other columns are ignored. Words are cut at spaces and tabs, pieces also at ``.,;:!?``
and U+000A to U+000D; A-Z become a-z.

Ranges are made for about 8 MB of text each, up to 65,536 of them (512 GB of text); beyond, ranges
grow with the text, and a range's n-grams are held by one task.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelflow.llm.automata import MOST_WORDS, Automaton, packed, summed, unpacked, united, width_of
from labelflow.llm.common import materialise

LEAST = 10
RANGE_BYTES = 8 << 20
MOST_RANGES = 65_536
#: Words that a task numbers and counts at a time, and texts that the range bounds are drawn from.
SHARD_WORDS = 1_000_000
SHARD_VOCABULARY = 1 << 20
SAMPLED_TEXTS = 20_000
#: Bytes of a word that count for a range bound, and n-grams of one automaton.
BOUND_BYTES = 48
SEGMENT = 200_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + b"\xff" * 10)
_END = b"\xff"  # no byte of UTF-8


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words, with ``_END`` between pieces."""
    return text.translate(_LOWER).replace(_END, b" \xff ").split()


# Prefix ranges


def _sample(batches: Iterable[pa.RecordBatch], each: int) -> Iterator[pa.RecordBatch]:
    """Evenly spaced trigrams of texts (lang, text) as (lang, words)."""
    for batch in batches:
        langs, out = [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = tokens(text)
            for at in range(0, len(words), max(1, len(words) // each)):
                phrase = []
                for w in words[at : at + 3]:
                    if w == _END:
                        break
                    phrase.append(w[:BOUND_BYTES])
                if phrase:
                    langs.append(lang)
                    out.append(phrase)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.list_(pa.binary()))], names=["lang", "words"])


def _bounds(rows: DataFrame) -> dict[str, list[tuple[bytes, ...]]]:
    """By language the first n-grams of its ranges but the first; at most MOST_RANGES of at most three short words each."""
    total, n = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    ranges = min(MOST_RANGES, max(1, -(-total // RANGE_BYTES)))
    if ranges == 1:
        return {}
    some = rows.where(F.rand(11) < SAMPLED_TEXTS / n) if n > SAMPLED_TEXTS else rows
    each = max(4, 8 * ranges // SAMPLED_TEXTS)
    drawn = some.mapInArrow(lambda batches: _sample(batches, each), "lang string, words array<binary>")
    drawn = sorted({(r["lang"], tuple(bytes(w) for w in r["words"])) for r in drawn.collect()})
    out: dict[str, list] = {}
    for k in range(1, ranges):
        lang, words = drawn[k * len(drawn) // ranges]
        if not out.get(lang) or out[lang][-1] < words:
            out.setdefault(lang, []).append(words)
    return out


class Ranges:
    """Numbers of the prefix ranges of each language; a language without bounds is one range."""

    def __init__(self, bounds: dict[str, list[tuple[bytes, ...]]]):
        self.bounds = bounds

    def cut(self, lang: str, words: list[bytes], keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
        """(range, low, high) of the n-grams ``keys`` of sorted ``words`` that each range holds."""
        edges = []
        for bound in self.bounds.get(lang, ()):
            edge = 0
            for depth, w in enumerate(bound):
                at = bisect_left(words, w)
                same = at < len(words) and words[at] == w
                edge += (at + 1) << (2 - depth) * bits
                if not same:
                    break
            edges.append(edge)
        # a word beyond the last one would not fit its bits
        at = [0, *np.searchsorted(keys, np.minimum(np.asarray(edges, object), 2**63 - 1).astype(np.int64)).tolist(), len(keys)] if edges else [0, len(keys)]
        for k, (low, high) in enumerate(zip(at, at[1:])):
            if high > low:
                yield k, low, high

    def segments(self, lang: str, words: list[bytes], keys: np.ndarray, weights: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
        for k, low, high in self.cut(lang, words, keys, bits):
            for at in range(low, high, SEGMENT):
                end = min(high, at + SEGMENT)
                yield k, Automaton.build(words, keys[at:end], weights[at:end], bits).dump()


# Counting


def _shard(lang: str, ids: array, vocabulary: list[bytes], ranges: Ranges) -> Iterator[tuple]:
    """(lang, range, automaton) of the n-grams of one shard's words, given by number of arrival (0: end of a piece)."""
    ids = np.frombuffer(ids, np.uint32)
    used = np.unique(ids)
    words = sorted(vocabulary[i] for i in used.tolist() if i)
    number = {w: i + 1 for i, w in enumerate(words)}
    rank = np.zeros(len(vocabulary), np.int64)
    for i in used.tolist():
        if i:
            rank[i] = number[vocabulary[i]]
    bits = width_of(len(words))
    w = np.concatenate((rank[ids], [0, 0]))
    a, b, c = w[:-2], w[1:-1], w[2:]
    zero = np.zeros(1, np.int64)
    one, two, three = a > 0, (a > 0) & (b > 0), (a > 0) & (b > 0) & (c > 0)
    keys = np.concatenate((packed(a[one], zero, zero, bits), packed(a[two], b[two], zero, bits), packed(a[three], b[three], c[three], bits)))
    keys, counts = np.unique(keys, return_counts=True)
    for k, data in ranges.segments(lang, words, keys, counts.astype(np.int64), bits):
        yield lang, k, data


def _batch(rows: list[tuple], names: str) -> pa.RecordBatch:
    kinds = {"lang": pa.string(), "data": pa.binary(), "phrase": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(x, kinds.get(n, pa.int64())) for n, x in zip(names.split(), zip(*rows))], names=names.split())


def _count(batches: Iterable[pa.RecordBatch], ranges: Ranges) -> Iterator[pa.RecordBatch]:
    """Automata of texts (lang, text), for each shard of words and range."""
    number: defaultdict[bytes, int] = defaultdict()
    shards: dict[str, array] = {}

    def clear():
        number.clear()
        number.default_factory = number.__len__
        number[_END]
        shards.clear()

    def done():
        vocabulary = list(number)
        for lang, ids in shards.items():
            for row in _shard(lang, ids, vocabulary, ranges):
                yield _batch([row], "lang range data")

    clear()
    total = 0
    for batch in batches:
        for first in range(0, batch.num_rows, 64):
            part = batch.slice(first, 64)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = tokens(text)
                # a very long text is counted in shards that share two words, whose n-grams count once
                for at in range(0, len(words), SHARD_WORDS):
                    if at:
                        total = SHARD_WORDS
                    if total >= SHARD_WORDS or len(number) >= SHARD_VOCABULARY:
                        yield from done()
                        clear()
                        total = 0
                    ids = shards.setdefault(lang, array("I"))
                    ids.extend(map(number.__getitem__, words[at : at + SHARD_WORDS]))
                    total += min(SHARD_WORDS, len(words) - at)
                    if at + SHARD_WORDS < len(words):
                        yield from _across(lang, words, at + SHARD_WORDS, ranges)
                if words:
                    shards[lang].append(0)
    yield from done()


def _across(lang: str, words: list[bytes], at: int, ranges: Ranges) -> Iterator[pa.RecordBatch]:
    """The n-grams that start before word ``at`` and end at it or later."""
    some = sorted({w for w in words[max(0, at - 2) : at + 2] if w != _END})
    bits = width_of(len(some))
    found = []
    for start in (at - 2, at - 1):
        for end in range(at + 1, min(start + 3, len(words)) + 1):
            gram = words[start:end] if start >= 0 else []
            if len(gram) > 1 and _END not in gram:
                found.append([bisect_left(some, w) + 1 for w in gram] + [0] * (3 - len(gram)))
    if found:
        a, b, c = np.asarray(found, np.int64).T
        keys, counts = np.unique(packed(a, b, c, bits), return_counts=True)
        for k, data in ranges.segments(lang, some, keys, counts.astype(np.int64), bits):
            yield _batch([(lang, k, data)], "lang range data")


def _groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows that come sorted by their first ``keys`` columns, group by group; a group is read before the next is asked for."""
    def rows():
        for batch in batches:
            for first in range(0, batch.num_rows, 16):
                yield from zip(*(c.to_pylist() for c in batch.slice(first, 16).columns))

    return groupby(rows(), key=lambda r: r[:keys])


def _sum(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows (lang, range, data) to the range's one automaton of frequent n-grams, and the number of its words."""
    for (lang, k), rows in _groups(batches, 2):
        waiting: list[Automaton] = []
        n = size = 0
        for row in rows:
            waiting.append(Automaton.load(row[2]))
            n += waiting[-1].total()
            size += len(waiting[-1].label)
            if size > 8 * SEGMENT and len(waiting) > 8 and sum(len(x.words) for x in waiting) <= MOST_WORDS:
                waiting = [Automaton.build(*united(waiting))]
                size = 0
        yield _batch([(lang, k, n, Automaton.build(*united(waiting, least)).dump())], "lang range n data")


# Parts

#: What a row that meets in a range is: its counts, a request, a reply, candidates to drop.
_COUNTS, _REQUEST, _REPLY, _DROP = range(4)


def _candidates(counts: Automaton) -> tuple[np.ndarray, ...]:
    a, b, c, w = counts.ngrams()
    some = b > 0
    return a[some], b[some], c[some], w[some]


def _ask(batches: Iterable[pa.RecordBatch], ranges: Ranges) -> Iterator[pa.RecordBatch]:
    """For each range (lang, range, data) the requests for its candidates' parts: (lang, range asked, kind, range asking, automaton)."""
    for batch in batches:
        for lang, k, data in zip(*(c.to_pylist() for c in batch.columns)):
            yield _batch([(lang, k, _COUNTS, k, data)], "lang range kind other data")
            counts = Automaton.load(data)
            a, b, c, w = _candidates(counts)
            if not len(a):
                continue
            bits = width_of(len(counts.words))
            zero = np.zeros(1, np.int64)
            triple = c > 0
            last = np.where(triple, c, b)
            keys = np.concatenate((packed(a, zero, zero, bits), packed(last, zero, zero, bits), packed(a[triple], b[triple], zero, bits), packed(b[triple], c[triple], zero, bits)))
            weights = np.concatenate((w, w, w[triple], w[triple]))
            order = np.lexsort((weights, keys))
            keys, weights = keys[order], weights[order]
            final = np.flatnonzero(np.append(keys[1:] != keys[:-1], True))  # the greatest weight of each part
            for to, request in ranges.segments(lang, counts.words, keys[final], weights[final], bits):
                yield _batch([(lang, to, _REQUEST, k, request)], "lang range kind other data")


def _answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Requests, composed with the range's counts: (lang, range, kind, automaton) for those who asked, and what to drop here."""
    for (lang, k), rows in _groups(batches, 2):
        counts, drop = None, set()
        for _, _, kind, other, data in rows:
            if kind == _COUNTS:
                counts = Automaton.load(data)
                bits = width_of(len(counts.words))
                yield _batch([(lang, k, _COUNTS, data)], "lang range kind data")
                continue
            asked = Automaton.load(data)
            a, b, c, longer, found = asked.composed(counts)
            own = width_of(len(asked.words))
            keys = packed(a, b, c, own)
            order = np.argsort(keys)
            yield _batch([(lang, other, _REPLY, Automaton.build(asked.words, keys[order], found[order], own).dump())], "lang range kind data")
            # only three-word candidates ask for pairs
            for i in np.flatnonzero((b > 0) & (100 * longer >= 50 * found)).tolist():
                drop.add(counts.numbers[asked.words[a[i] - 1]] << 2 * bits | counts.numbers[asked.words[b[i] - 1]] << bits)
        if drop:
            keys = np.asarray(sorted(drop), np.int64)
            yield _batch([(lang, k, _DROP, Automaton.build(counts.words, keys, np.ones(len(keys), np.int64), bits).dump())], "lang range kind data")


def _score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of each range with their weakest cut, from its counts and the replies to it."""
    for (lang, _), rows in _groups(batches, 2):
        counts, replies, drops = None, [], []
        for _, _, kind, data in rows:
            if kind == _COUNTS:
                counts = Automaton.load(data)
            else:
                (replies if kind == _REPLY else drops).append(Automaton.load(data))
        a, b, c, w = _candidates(counts)
        if not len(a):
            continue
        # words of the replies and of the drops are words of this range's candidates
        bits = width_of(len(counts.words))

        def table(parts):
            words, keys, weights, own = united(parts)
            mine = np.asarray([0, *(counts.numbers[x] for x in words)], np.int64)
            x, y, z = unpacked(keys, own)
            return summed(packed(mine[x], mine[y], mine[z], bits), weights)

        keys, values = table(replies)
        zero = np.zeros(1, np.int64)

        def count(x, y):
            return values[np.searchsorted(keys, packed(x, y, zero, bits))]

        triple = c > 0
        dropped = np.isin(packed(a, b, c, bits), table(drops)[0]) if drops else np.zeros(len(a), bool)
        l1, r1 = count(a, zero), count(b, np.where(triple, c, 0))
        l2, r2 = l1.copy(), r1.copy()
        l2[triple], r2[triple] = count(a[triple], b[triple]), count(c[triple], zero)
        out = []
        for i in np.flatnonzero(~dropped).tolist():
            f, left, right = int(w[i]), int(l1[i]), int(r1[i])
            score = 1_000_000 * f * f // (left * right)
            if triple[i]:
                other = 1_000_000 * f * f // (int(l2[i]) * int(r2[i]))
                if other < score:
                    score, left, right = other, int(l2[i]), int(r2[i])
            phrase = b" ".join(counts.words[x - 1] for x in (a[i], b[i], c[i]) if x)
            out.append((lang, phrase.decode(), f, left, right, score))
        for at in range(0, len(out), 5000):
            yield _batch(out[at : at + 5000], "lang phrase a l r score")


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """All phrases that are not dropped: lang, phrase, a, l, r, n, score."""
    if least < 1:
        raise ValueError("least must be at least 1")
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].cast("string").cast("binary").alias("text")).where("text is not null")
    ranges = Ranges(_bounds(rows))
    shards = rows.mapInArrow(lambda batches: _count(batches, ranges), "lang string, range bigint, data binary")
    by_range = ["lang", "range"]
    summed_up = shards.repartition(*by_range).sortWithinPartitions(*by_range).mapInArrow(lambda batches: _sum(batches, least), "lang string, range bigint, n bigint, data binary")
    summed_up = materialise(summed_up, "collocation-counts")
    met = summed_up.drop("n").mapInArrow(lambda batches: _ask(batches, ranges), "lang string, range bigint, kind bigint, other bigint, data binary")
    met = met.repartition(*by_range).sortWithinPartitions(*by_range, "kind", "other").mapInArrow(_answer, "lang string, range bigint, kind bigint, data binary")
    scored = met.repartition(*by_range).sortWithinPartitions(*by_range, "kind").mapInArrow(_score, "lang string, phrase string, a bigint, l bigint, r bigint, score bigint")
    words = summed_up.groupBy("lang").agg(F.sum("n").alias("n"))
    return scored.join(words, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def top(phrases: DataFrame, k: int = 2000) -> DataFrame:
    """The first ``k`` of each language by score, a (both descending) and phrase, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))
