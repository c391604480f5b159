"""Runs of periodically repeating words, by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``least`` words and three periods
long, that no neighbouring word extends. Texts of a task are laid end to end, each closed by a
symbol of its own, and indexed together, so that a short text costs no more than its words.

* A suffix array of the words is built by prefix doubling. The doubling step to depth L gives
  the interval of every block of L words.
* A wavelet matrix over the suffix array answers range successor queries: the first place at or
  after x where a block occurs.
* For each power of two L from 8 up, blocks start at every multiple of L/2. A run of period q in
  [L, 2L) holds such a block early enough for its copy q words on to be in the run too, so the
  copy's place is among the occurrences in the window [L, 2L) words on. (Blocks of 8 words serve
  the shorter periods too.) Occurrences in a window of L starts are at most two, or else an
  arithmetic progression whose difference is the block's own period. Of two, both distances are
  candidates; a progression lies in one stretch of that short period, and the candidate is the
  distance between the ends of the block's stretch and of the progression's (the short period if
  they are one stretch).
* A candidate is extended word by word both ways; where several periods give one stretch, the
  smallest is its period.

Words are maximal runs of characters other than space and U+0009 to U+000D. Null and blank texts
have no words. Each row is judged by itself, so repeated rows get equal results and a null id is
as good as any. An empty table gives no rows. Other columns are ignored. A text is indexed whole;
memory grows with the longest text of a task, about 200 bytes a word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from labelflow.llm.common import field, id_text, parts

LEAST = 24
BLOCK = 8
#: Words that are indexed together, unless one text alone has more.
BATCH_WORDS = 200_000


class WaveletMatrix:
    """Counts and order statistics of any range of a sequence of non-negative integers, many at a time."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for k in range(bits - 1, -1, -1):
            bit = ((values >> k) & 1).astype(bool)
            ones = np.zeros(len(values) + 1, np.int64)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((k, ones, len(values) - ones[-1]))
            values = np.concatenate((values[~bit], values[bit]))

    def count_below(self, lo, hi, x) -> np.ndarray:
        """How many of the values lo..hi are less than x."""
        found = np.zeros(len(lo), np.int64)
        for k, ones, zeros in self.levels:
            low, high, bit = ones[lo], ones[hi], (x >> k) & 1 == 1
            found += np.where(bit, hi - lo - high + low, 0)
            lo, hi = np.where(bit, zeros + low, lo - low), np.where(bit, zeros + high, hi - high)
        return found

    def nth(self, lo, hi, n) -> np.ndarray:
        """The n-th smallest (from 0) of the values lo..hi."""
        value = np.zeros(len(lo), np.int64)
        for k, ones, zeros in self.levels:
            low, high = ones[lo], ones[hi]
            below = hi - lo - high + low
            bit = n >= below
            n = np.where(bit, n - below, n)
            value |= bit.astype(np.int64) << k
            lo, hi = np.where(bit, zeros + low, lo - low), np.where(bit, zeros + high, hi - high)
        return value

    def successor(self, lo, hi, x) -> np.ndarray:
        """The smallest of the values lo..hi that is at least x, or -1."""
        out = np.full(len(lo), -1, np.int64)
        below = self.count_below(lo, hi, x)
        some = np.flatnonzero(below < hi - lo)
        if len(some):
            out[some] = self.nth(lo[some], hi[some], below[some])
        return out


def suffix_array(words: np.ndarray, longest: int) -> tuple[np.ndarray, dict[int, tuple]]:
    """The suffix array, and for each depth 8, 16, ... up to ``longest`` the repeated blocks.

    A depth's entry is (places, lo, hi): multiples of half the depth whose block occurs more than
    once, and their intervals in the array. The last word must occur nowhere else.
    """
    n = len(words)
    width = max(1, int(words.max()).bit_length())
    depth = 4 if 4 * width <= 62 else 2
    padded = np.concatenate((words, np.zeros(depth, np.int64)))
    key = padded[:n].copy()
    for i in range(1, depth):
        key <<= width
        key |= padded[i : i + n]
    sa = np.argsort(key)
    key = key[sa]
    new = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    at = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, at, 0))
    slots = at  # of the array whose suffix is not settled yet
    blocks = {}
    while True:
        # ``new`` marks the starts of the groups among ``slots``; groups of one are settled
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(slots)))
        open_ = np.repeat(size > 1, size)
        end = np.repeat(slots[starts] + size, size)[open_]
        slots = slots[open_]
        if depth >= BLOCK and depth <= longest:
            place = sa[slots]
            mine = place % (depth // 2) == 0
            blocks[depth] = (place[mine], rank[place[mine]], end[mine])
        if not len(slots):
            return sa, blocks
        sub = sa[slots]
        first = rank[sub]
        after = sub + depth
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        order = np.lexsort((second, first))
        sub, first, second = sub[order], first[order], second[order]
        sa[slots] = sub
        new = np.ones(len(sub), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        rank[sub] = np.maximum.accumulate(np.where(new, slots, 0))
        depth *= 2


def _same_until(words: np.ndarray, at: int, gap: int) -> int:
    """The first place from ``at`` on whose word differs from that ``gap`` words later."""
    step = 32
    while True:
        a, b = words[at : at + step], words[at + gap : at + gap + step]
        differ = a[: len(b)] != b
        if differ.any():
            return at + int(differ.argmax())
        at += len(b)
        if len(b) < step:
            return at
        step *= 4


def _same_from(words: np.ndarray, at: int, gap: int) -> int:
    """The first place of the equal words, each with that ``gap`` words later, that end before ``at``."""
    step = 32
    while at > 0:
        low = max(0, at - step)
        differ = words[low:at] != words[low + gap : at + gap]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, step = low, step * 4
    return 0


class _Ends:
    """``_same_until`` for rising places: a stretch is walked once, not once for each of its blocks."""

    def __init__(self, words: np.ndarray):
        self.words, self.known = words, {}

    def __call__(self, at: int, gap: int) -> int:
        low, high = self.known.get(gap, (0, -1))
        if not low <= at <= high:
            high = _same_until(self.words, at, gap)
            self.known[gap] = (at, high)
        return high


def _candidates(words: np.ndarray, longest: int) -> Iterator[tuple[int, int]]:
    """(place, distance) of blocks and their likely periods, by rising place inside each depth."""
    sa, blocks = suffix_array(words, max(BLOCK, longest // 3))
    if not any(len(place) for place, _, _ in blocks.values()):
        return
    # only suffixes whose first block repeats are ever asked for; the others leave no gap inside an interval
    n = len(sa)
    kept = np.zeros(n + 1, np.int64)
    repeated = _repeated(sa, words)
    np.cumsum(repeated, out=kept[1:])
    tree = WaveletMatrix(sa[repeated], (2 * n).bit_length())
    del sa
    for depth in sorted(blocks):
        place, lo, hi = blocks[depth]
        order = np.argsort(place)
        place, lo, hi = place[order], kept[lo[order]], kept[hi[order]]
        for low, high in ((1, BLOCK), (BLOCK, 2 * BLOCK)) if depth == BLOCK else ((depth, 2 * depth),):
            one = tree.successor(lo, hi, place + low)
            some = np.flatnonzero((one >= 0) & (one < place + high))
            if not len(some):
                continue
            b, one, l, h = place[some], one[some], lo[some], hi[some]
            two = tree.successor(l, h, one + 1)
            two[two >= b + high] = -1
            three = tree.successor(l, h, np.maximum(two, one) + 1)
            three[(two < 0) | (three >= b + high)] = -1
            here, there = _Ends(words), _Ends(words)
            for at, x, y, z in zip(b.tolist(), one.tolist(), two.tolist(), three.tolist()):
                if z >= 0:
                    short = y - x
                    yield at, (there(x, short) - here(at, short)) or short
                else:
                    yield at, x - at
                    if y >= 0:
                        yield at, y - at


def _repeated(sa: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Marks the suffixes of the array that share their first block with a neighbour."""
    n = len(sa)
    same = np.ones(n - 1, bool)
    padded = np.concatenate((words, np.zeros(BLOCK, np.int64)))
    for i in range(BLOCK):
        here = np.flatnonzero(same)
        same[here] = padded[sa[here] + i] == padded[sa[here + 1] + i]
    mark = np.zeros(n, bool)
    mark[:-1] |= same
    mark[1:] |= same
    return mark


def runs_of(words: np.ndarray, longest: int, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs, sorted; texts in ``words`` end with a symbol of their own."""
    found: dict[tuple[int, int], int] = {}
    last: dict[int, tuple[int, int]] = {}  # by distance, the stretch found last
    for at, gap in _candidates(words, longest):
        if gap <= 0:
            continue
        low, high = last.get(gap, (0, -1))
        if low <= at < high:
            continue
        low, high = _same_from(words, at, gap), _same_until(words, at, gap)
        last[gap] = (low, high)
        if high + gap - low >= max(least, 3 * gap):
            stretch = (low, high + gap)
            found[stretch] = min(gap, found.get(stretch, gap))
    return sorted((low, high, gap) for (low, high), gap in found.items())


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """Greatest length by period, then smallest start, then smallest period."""
    best = runs[0]
    for run in runs[1:]:
        a, b = run[1] * best[2], best[1] * run[2]
        if a > b or a == b and (run[0], run[2]) < (best[0], best[2]):
            best = run
    return best


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


def _indexed(texts: list[list[bytes]], least: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text."""
    out: list[list] = [[] for _ in texts]
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = lambda: len(number) + 1
    owners = [i for i, words in enumerate(texts) if len(words) >= least]
    if not owners:
        return out
    pieces = [np.fromiter(map(number.__getitem__, texts[i]), np.int64, len(texts[i])) for i in owners]
    begin, at = [], 0
    closed = []
    for k, piece in enumerate(pieces):
        begin.append(at)
        closed += [piece, [len(number) + 1 + k]]
        at += len(piece) + 1
    for low, high, gap in runs_of(np.concatenate(closed), max(map(len, pieces)), least):
        k = int(np.searchsorted(begin, low, "right")) - 1
        out[owners[k]].append((low - begin[k], high - low, gap))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _map(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    kept: list = []
    texts: list[list[bytes]] = []

    def done():
        runs = _indexed(texts, least)
        written = [[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs]
        best = [dict(zip(("start", "length", "period"), _best(x))) if x else None for x in runs]
        return pa.RecordBatch.from_arrays(
            [pa.array(kept, kind), pa.array(map(len, texts), pa.int64()), pa.array(written, pa.list_(_RUN)), pa.array(best, _RUN),
             pa.array([_collapsed(t, r) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string())],
            names=["id", "n_words", "runs", "best", "collapsed"])

    total, kind = 0, None
    for batch in batches:
        kind = batch.schema.field(0).type
        for ids, rows in parts([batch]):
            for key, text in zip(ids, rows):
                kept.append(key)
                texts.append(text.split() if text else [])
                total += len(texts[-1])
                if total >= BATCH_WORDS or len(kept) >= 10_000:
                    yield done()
                    kept, texts, total = [], [], 0
    if kept:
        yield done()


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Per row: the id, n_words, all runs, the best run (or null) and the text with repeats collapsed.

    ``best`` has the greatest length by period; of equals the first, then the shortest period.
    ``collapsed`` keeps of each run the first period, joined by single spaces.
    """
    if least < LEAST:
        raise ValueError(f"runs shorter than {LEAST} words may hold no whole block of {BLOCK}")
    run = "struct<start: bigint, length: bigint, period: bigint>"
    schema = f"{field('id', docs, id_col)}, n_words bigint, runs array<{run}>, best {run}, collapsed string"
    rows = id_text(docs, id_col, text_col)
    rows = rows.select("id", rows["text"].cast("binary").alias("text"))
    return rows.mapInArrow(lambda batches: _map(batches, least), schema).withColumnRenamed("id", id_col)
