"""Removal of long byte strings that occur more than once, by a sparse suffix array.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts somewhere else, in
the same text or another. Strings are judged on the input and never cross texts.

* Anchors. Of the ``GRAM``-byte grams inside a string, the one with the least hash (of equals the
  first) is its anchor. Two equal strings choose the same gram, so each repeated string is seen
  at a pair of anchors with equal grams. About every 75th byte is an anchor. Only anchors whose
  gram repeats go on: the suffixes that start there, and their prefixes read backwards, are sorted.
* Contexts. What an anchor can decide lies in the bytes from LENGTH - GRAM before it to LENGTH
  after it. Anchors with equal contexts settle each other at once, so a group of copies
  is one context, however large. Only different contexts of one gram are sorted.
* Deep-shallow sorting. A task sorts its suffixes by multikey quicksort on words of eight bytes
  down to ``SHALLOW`` bytes; groups that still agree there are ordered by a blind trie, which looks
  at one byte a branch and compares one suffix in full for each insertion. Both give the common
  prefix of neighbours.
* A string that starts d bytes before its anchor repeats if another context agrees with
  this one on d bytes to the left and LENGTH - d to the right: both orders cut at these depths
  give classes, and a pair of classes that two contexts share is a repeat. All strings of
  an anchor hold the anchor, so what they cover is one stretch, from the largest such d to the smallest.
* A gram with more than ``HOT`` contexts is not gathered in a task: its strings are counted by Spark.

A null text is empty. A text of fewer than LENGTH bytes keeps all. Repeated rows remove
each other if they are long enough. Row ids play no part: a text is known by two 64-bit hashes, so rows
may repeat and ids may be null. An empty table gives no rows. Other columns are ignored. Gram hashes
only propose; contexts are compared by 128-bit hashes and by their bytes. Long texts are scanned
in pieces that overlap by a string.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import field, id_text, materialise

LENGTH = 200
GRAM = 48
BACK = LENGTH - GRAM
SHALLOW = 64
HOT = 50_000
#: Bytes that are hashed at once (a task holds about a hundred times as much for it), and contexts
#: that are sorted at once unless one gram has more.
PIECE = 1 << 17
SORTED = 20_000
_SEEN = 200_000
_KEY = ["k1", "k2"]
_CLASS = ["h", "c1", "c2"]


# Anchors


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the gram that starts at each byte, as far as whole grams go."""
    up, down = _powers(2 * PIECE + LENGTH)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[GRAM:] - sums[: n + 1 - GRAM]) * down[: n + 1 - GRAM]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values: two running minima, forwards and backwards inside blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(table, axis=1).reshape(-1)
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, usable: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places, gram hashes) of the anchors of the strings that start where ``usable``."""
    h = gram_hashes(data)
    low = np.uint64((1 << 22) - 1)
    best = _least((h & ~low) | np.arange(len(h), dtype=np.uint64), BACK + 1)
    if usable is not None:
        best = best[usable[: len(best)]]
    places = (best & low).astype(np.int64)
    places = places[np.insert(np.diff(places) != 0, 0, True)] if len(places) else places
    return places, h[places].view(np.int64)


def _text_anchors(texts: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(number of the text, place in it, gram hash) of all anchors."""
    def group(members):
        data = np.frombuffer(b"".join(texts[i] for i in members), np.uint8)
        ends = np.cumsum([len(texts[i]) for i in members])
        usable = np.ones(len(data), bool)
        for end in ends:
            usable[max(0, end - LENGTH + 1) : end] = False
        places, h = anchors(data, usable)
        owner = np.searchsorted(ends, places, "right")
        begins = np.insert(ends[:-1], 0, 0)
        return zip(np.asarray(members)[owner].tolist(), (places - begins[owner]).tolist(), h.tolist())

    members, total = [], 0
    for i, text in enumerate(texts):
        n = len(text)
        if n < LENGTH:
            continue
        if n > PIECE:
            last = -1
            for at in range(0, n - LENGTH + 1, PIECE):
                places, h = anchors(np.frombuffer(text, np.uint8, min(PIECE + LENGTH - 1, n - at), at))
                for p, x in zip((places + at).tolist(), h.tolist()):
                    if p > last:
                        yield i, p, x
                        last = p
            continue
        members.append(i)
        total += n
        if total > PIECE:
            yield from group(members)
            members, total = [], 0
    if members:
        yield from group(members)


def _context(text: bytes, at: int) -> tuple[bytes, int]:
    left = min(at, BACK)
    return text[at - left : at + LENGTH], left


def _binary_rows(column: pa.Array, step: int = 128) -> Iterator[tuple[int, list[bytes]]]:
    for at in range(0, len(column), step):
        yield at, column.slice(at, step).to_pylist()


_ANCHOR = "h bigint, c1 bigint, c2 bigint, k1 bigint, k2 bigint, at int"


def _anchor_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of texts (k1, k2, text); of copies that a task has seen lately, none."""
    seen: set[bytes] = set()
    for batch in batches:
        k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        keys = np.stack((k1, k2), 1).tobytes()
        for first, texts in _binary_rows(batch.column(2)):
            for i, text in enumerate(texts):
                key = keys[16 * (first + i) : 16 * (first + i + 1)]
                if len(text) < LENGTH or key in seen:
                    texts[i] = b""
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(key)
            owner, place, gram, context = [], [], [], []
            for i, at, h in _text_anchors(texts):
                left = at if at < BACK else BACK
                owner.append(first + i)
                place.append(at)
                gram.append(h)
                context.append(xxhash.xxh3_128_digest(texts[i][at - left : at + LENGTH], left))
            if owner:
                c = np.frombuffer(b"".join(context), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram, pa.int64()), pa.array(c[:, 0]), pa.array(c[:, 1]), pa.array(k1[owner]), pa.array(k2[owner]), pa.array(place, pa.int32())],
                    names=["h", "c1", "c2", "k1", "k2", "at"])


# Sorting


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class _Branch:
    """A branching node of a blind trie: the depth of its byte and the subtrees by that byte (-1: the string ends)."""

    __slots__ = ("depth", "next")

    def __init__(self, depth, children):
        self.depth, self.next = depth, children


def blind_trie_order(strings: list[bytes], members: list[int]) -> list[tuple[int, int]]:
    """(member, common prefix with the one before) in order; equal strings keep their given order.

    A leaf is a list of equal strings. The search looks at branching bytes only and may end at a
    wrong leaf; one comparison with any string below tells where the new one leaves the path.
    """
    root: _Branch | list = [members[0]]
    for m in members[1:]:
        s = strings[m]
        n = len(s)
        node = root
        while type(node) is _Branch:
            node = node.next.get(s[node.depth] if node.depth < n else -1) or next(iter(node.next.values()))
        other = strings[node[0]]
        same = _common(s, other)
        if same == n == len(other):
            node.append(m)
            continue
        parent, node = None, root
        while type(node) is _Branch and node.depth < same:
            parent, node = node, node.next[s[node.depth]]
        mine = s[same] if same < n else -1
        if type(node) is _Branch and node.depth == same:
            node.next[mine] = [m]
            continue
        branch = _Branch(same, {mine: [m], other[same] if same < len(other) else -1: node})
        if parent is None:
            root = branch
        else:
            parent.next[s[parent.depth]] = branch
    out: list[tuple[int, int]] = []
    todo: list[tuple] = [(root, 0)]
    while todo:
        node, before = todo.pop()
        if type(node) is _Branch:
            keys = sorted(node.next, reverse=True)
            todo += [(node.next[k], node.depth) for k in keys[:-1]] + [(node.next[keys[-1]], before)]
        else:
            out.append((node[0], before))
            out += [(m, len(strings[m])) for m in node[1:]]
    return out


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings and the common prefix of each with the one before (the first: 0)."""
    order: list[int] = []
    common: list[int] = []

    def put(members, before):
        # a member or a group that agrees on ``shallow`` bytes
        ordered = [(members[0], 0)] if len(members) == 1 else blind_trie_order(strings, members)
        order.extend(m for m, _ in ordered)
        common.append(before)
        common.extend(c for _, c in ordered[1:])

    if not strings:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    todo = [(list(range(len(strings))), 0)]
    while todo:
        members, depth = todo.pop()
        if len(members) == 1 or depth >= shallow:
            put(members, _common(strings[order[-1]], strings[members[0]]) if order else 0)
            continue
        words = {m: strings[m][depth : depth + 8] for m in members}
        pivot = words[members[len(members) // 2]]
        less = [m for m in members if words[m] < pivot]
        more = [m for m in members if words[m] > pivot]
        if more:
            todo.append((more, depth))
        same = [m for m in members if words[m] == pivot]
        # strings that end inside the word are equal, and have no deeper word to be told apart by
        todo.append((same, depth + 8 if len(pivot) == 8 else shallow))
        if less:
            todo.append((less, depth))
    return np.asarray(order), np.asarray(common)


def _reach(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """By string, its longest common prefix with any other."""
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(common, np.append(common[1:], 0))
    return out


def repeated_offsets(contexts: list[bytes], lefts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """By context, the largest and the smallest d whose string, from d bytes before the anchor on, is in another context too; -1: none."""
    m = len(contexts)
    rights = [c[left:] for c, left in zip(contexts, lefts)]
    backs = [c[: left + GRAM][::-1] for c, left in zip(contexts, lefts)]
    (r_order, r_common), (l_order, l_common) = deep_shallow(rights), deep_shallow(backs)
    r_reach, l_reach = _reach(r_order, r_common), _reach(l_order, l_common) - GRAM
    high, low = np.full(m, -1, np.int64), np.full(m, -1, np.int64)
    r_class, l_class = np.empty(m, np.int64), np.empty(m, np.int64)
    for d in range(BACK + 1):
        some = np.flatnonzero((r_reach >= LENGTH - d) & (l_reach >= d))
        if not len(some):
            continue
        r_class[r_order] = np.cumsum(r_common < LENGTH - d)
        l_class[l_order] = np.cumsum(l_common < d + GRAM)
        _, which, count = np.unique(r_class[some] * (m + 1) + l_class[some], return_inverse=True, return_counts=True)
        some = some[count[which] > 1]
        high[some] = d
        low[some] = np.where(low[some] < 0, d, low[some])
    return high, low


def _sorted_contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decides contexts (h, c1, c2, left, context) that come with all of a gram's together."""
    rows: list[tuple] = []

    def done():
        high, low = repeated_offsets([r[4] for r in rows], [r[3] for r in rows])
        found = np.flatnonzero(high >= 0)
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][k] for i in found], pa.int64()) for k in range(3)] + [pa.array(high[found].astype(np.int32)), pa.array(low[found].astype(np.int32))],
            names=[*_CLASS, "high", "low"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if len(rows) >= SORTED and row[0] != rows[-1][0]:
                yield done()
                rows.clear()
            rows.append(row)
    if rows:
        yield done()


def _strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all strings of contexts (h, c1, c2, left, context)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = list(zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)))
            out = [(h, c1, c2, d, xxhash.xxh3_128_digest(context[left - d : left - d + LENGTH]))
                   for h, c1, c2, left, context in rows for d in range(left + 1) if left - d + LENGTH <= len(context)]
            if out:
                h, c1, c2, d, s = zip(*out)
                s = np.frombuffer(b"".join(s), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array(d, pa.int32()), pa.array(s[:, 0]), pa.array(s[:, 1])],
                                                 names=[*_CLASS, "d", "s1", "s2"])


# Texts


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of the asked anchors (text, list of h, c1, c2, at)."""
    for batch in batches:
        for i in range(batch.num_rows):
            text, asked = batch.column(0)[i].as_py(), batch.column(1)[i].values
            h, c1, c2, at = (asked.field(k) for k in range(4))
            for first in range(0, len(asked), 2048):
                cut = [_context(text, p) for p in at.slice(first, 2048).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [x.slice(first, 2048) for x in (h, c1, c2)] + [pa.array([left for _, left in cut], pa.int32()), pa.array([c for c, _ in cut], pa.binary())],
                    names=[*_CLASS, "left", "context"])


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of the union of intervals; those that touch are one."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    first = np.flatnonzero(np.insert(lo[1:] > hi[:-1], 0, True))
    return lo[first], hi[np.append(first[1:], len(lo)) - 1]


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (k1, k2, text, list of at, high, low) without the bytes their anchors cover."""
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            spans, kept, removed = [], [], []
            for i in range(part.num_rows):
                text, found = part.column(2)[i].as_py(), part.column(3)[i].values
                at, high, low = (found.field(k).to_numpy().astype(np.int64) for k in range(3))
                lo, hi = merged(np.maximum(0, at - high), np.minimum(len(text), at - low + LENGTH))
                spans.append([{"start": a, "end": b} for a, b in zip(lo.tolist(), hi.tolist())])
                keep = np.diff(np.concatenate(([0], np.stack((lo, hi), 1).reshape(-1), [len(text)])))[::2]
                begin = np.concatenate(([0], hi))
                kept.append(b"".join(text[a : a + n] for a, n in zip(begin.tolist(), keep.tolist())))
                removed.append(len(text) - len(kept[-1]))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(_SPAN)), pa.array(kept, pa.binary())],
                                             names=["k1", "k2", "n_removed", "spans", "kept"])


def text_key(text: Column) -> list[Column]:
    """Two hashes that a text is known by."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def removed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A row for each distinct text that loses something: k1, k2 (``text_key``), n_removed, spans and the kept bytes."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary")
    texts = docs.select(*text_key(text), text.alias("text")).where(F.octet_length("text") >= LENGTH)
    copies = materialise(texts.groupBy(*_KEY).agg(F.count("*").alias("n"), F.max(F.octet_length("text")).cast("long").alias("bytes")).where("n > 1"), "suffix-copies")

    found = texts.select(*_KEY, "text").mapInArrow(_anchor_rows, _ANCHOR)
    # written first: Spark splits a hot gram's rows in a join of two plain shuffles, but not next to an aggregate
    again = materialise(found.groupBy("h").count().where("count > 1").select("h"), "suffix-again")
    found = materialise(found.join(again.hint("merge"), "h"), "suffix-anchors")

    classes = materialise(found.groupBy(*_CLASS).agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "at")).alias("first")), "suffix-classes")
    grams = materialise(classes.groupBy("h").agg(F.count("*").alias("m")).where("m > 1"), "suffix-grams")
    asked = classes.join(grams.hint("merge"), "h").groupBy("first.k1", "first.k2").agg(F.collect_list(F.struct(*_CLASS, F.col("first.at").alias("at"))).alias("asked"))
    distinct = texts.dropDuplicates(_KEY)
    contexts = (distinct.join(asked.hint("merge"), _KEY).select("text", "asked")
                .mapInArrow(_contexts, "h bigint, c1 bigint, c2 bigint, left int, context binary"))
    contexts = materialise(contexts, "suffix-contexts", "zstd")
    hot = materialise(grams.where(F.col("m") > HOT).select("h"), "suffix-hot")

    usual = contexts.join(hot, "h", "left_anti")
    decided = usual.repartition("h").sortWithinPartitions("h").mapInArrow(_sorted_contexts, "h bigint, c1 bigint, c2 bigint, high int, low int")
    strings = contexts.join(hot, "h", "left_semi").mapInArrow(_strings, "h bigint, c1 bigint, c2 bigint, d int, s1 bigint, s2 bigint")
    more = strings.groupBy("h", "d", "s1", "s2").count().where("count > 1").drop("count")
    counted = strings.join(more, ["h", "d", "s1", "s2"]).groupBy(*_CLASS).agg(F.max("d").alias("high"), F.min("d").alias("low"))
    decided = decided.unionByName(counted)

    # anchors with equal contexts repeat with every string the context has; merging below cuts what lies beyond the text
    settled = classes.where("n > 1").select(*_CLASS, F.lit(BACK).alias("high"), F.lit(0).alias("low"))
    decided = settled.unionByName(decided.join(settled.select(*_CLASS), _CLASS, "left_anti"))
    covered = (found.join(decided.hint("merge"), _CLASS).groupBy(*_KEY).agg(F.collect_list(F.struct("at", "high", "low")).alias("found"))
               .join(copies.select(*_KEY), _KEY, "left_anti"))
    cut = distinct.join(covered.hint("merge"), _KEY).select(*_KEY, "text", "found").mapInArrow(
        _cut, "k1 bigint, k2 bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")
    whole = copies.select(*_KEY, F.col("bytes").alias("n_removed"), F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("bytes").alias("end"))).alias("spans"),
                          F.lit("").cast("binary").alias("kept"))
    return cut.unionByName(whole)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_bytes, n_removed, the removed spans and the kept bytes."""
    rows = id_text(docs, id_col, text_col)
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = rows.select("id", *text_key(text), text.alias("own"))
    out = rows.join(removed(docs, text_col), _KEY, "left")
    kind = "array<struct<start: bigint, end: bigint>>"
    return out.select(F.col("id").alias(id_col), F.octet_length("own").cast("long").alias("n_bytes"), F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                      F.coalesce("spans", F.array().cast(kind)).alias("spans"), F.coalesce("kept", "own").alias("kept"))
