"""Weighted acyclic automata over words: counts of n-grams of one to three words.

An automaton is deterministic and minimal: states with the same weight and the same arcs are one.
A word sequence that leads to a state of weight w > 0 has count w. Sorted n-grams are added one prefix after
another, longer prefixes first: once all that continues a prefix has been seen, its state can't change any more,
and is looked up among the states made so far. Words are numbered in byte order, so n-grams in order are integers in order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable
from functools import cached_property

import numpy as np
import zstandard

#: Most words an n-gram has.
WORDS = 3


#: Most different words of one automaton: three numbers fit an integer.
MOST_WORDS = (1 << 21) - 1


def width_of(n: int) -> int:
    """Bits for the numbers 1 to ``n`` of words; 0 stands for no word."""
    bits = int(n).bit_length()
    if n > MOST_WORDS:
        raise ValueError(f"{n} different words in one automaton are too many for a 64-bit n-gram")
    return bits


def packed(a: np.ndarray, b: np.ndarray, c: np.ndarray, bits: int) -> np.ndarray:
    """N-grams as integers; prefixes stand before what continues them."""
    return (a << 2 * bits) | (b << bits) | c


def unpacked(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = (1 << bits) - 1
    return keys >> 2 * bits, (keys >> bits) & low, keys & low


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, each once, and their sums of weights."""
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.insert(keys[1:] != keys[:-1], 0, True)) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(keys) else weights


def _ranges(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places low, low + 1, ... of each range, one after another."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.arange(total) + np.repeat(low - np.cumsum(size) + size, size)


class Automaton:
    """Words; per state its weight and number of arcs; per arc, by state, word number and target. The last state is the start."""

    def __init__(self, words: list[bytes], weight: np.ndarray, arcs: np.ndarray, label: np.ndarray, target: np.ndarray):
        self.words, self.weight, self.arcs, self.label, self.target = words, weight, arcs, label, target
        self.first = np.concatenate(([0], np.cumsum(arcs)))

    @classmethod
    def build(cls, words: list[bytes], keys: np.ndarray, weights: np.ndarray, bits: int) -> Automaton:
        """From n-grams in order, each once; ``words`` (in byte order) may hold more than the n-grams need."""
        a, b, c = unpacked(keys, bits)
        used = np.unique(np.concatenate((a, b, c)))
        used = used[used > 0]
        number = np.zeros(len(words) + 1, np.int64)
        number[used] = np.arange(1, len(used) + 1)
        own = [words[i - 1] for i in used.tolist()]
        a, b, c = number[a], number[b], number[c]

        register: dict[tuple[int, bytes], int] = {}
        arcs: list[bytes] = []  # of each state: word number and target, four bytes each

        def states(own: np.ndarray, low: np.ndarray, high: np.ndarray, label: np.ndarray, target: np.ndarray) -> np.ndarray:
            """The states of prefixes in order, each with its own weight and the arcs low..high."""
            raw = np.stack((label, target), 1).astype(np.uint32).tobytes()
            made = []
            for w, i, j in zip(own.tolist(), (8 * low).tolist(), (8 * high).tolist()):
                key = (w, raw[i:j])
                found = register.get(key)
                if found is None:
                    found = register[key] = len(arcs)
                    arcs.append(key[1])
                made.append(found)
            return np.asarray(made, np.int64)

        none = np.zeros(0, np.int64)
        full, pair = c > 0, b > 0
        # n-grams of full length end in states without arcs, one for each weight
        values, leaf = np.unique(weights[full], return_inverse=True)
        nil = np.zeros(len(values), np.int64)
        leaves = states(values, nil, nil, none, none)

        ab = (a << bits) | b
        heads2, heads1 = np.unique(ab[pair]), np.unique(a)
        own2, own1 = np.zeros(len(heads2), np.int64), np.zeros(len(heads1), np.int64)
        own2[np.searchsorted(heads2, ab[pair & ~full])] = weights[pair & ~full]
        own1[np.searchsorted(heads1, a[~pair])] = weights[~pair]
        made2 = states(own2, np.searchsorted(ab[full], heads2, "left"), np.searchsorted(ab[full], heads2, "right"), c[full], leaves[leaf] if len(values) else none)
        firsts = heads2 >> bits
        made1 = states(own1, np.searchsorted(firsts, heads1, "left"), np.searchsorted(firsts, heads1, "right"), heads2 & ((1 << bits) - 1), made2)
        weight = np.fromiter((w for w, _ in register), np.int64, len(register))
        arcs.append(np.stack((heads1, made1), 1).astype(np.uint32).tobytes())
        every = np.frombuffer(b"".join(arcs), np.uint32).reshape(-1, 2).astype(np.int64)
        return cls(own, np.append(weight, 0), np.fromiter(map(len, arcs), np.int64, len(arcs)) // 8, every[:, 0], every[:, 1])

    @cached_property
    def numbers(self) -> dict[bytes, int]:
        return {w: i + 1 for i, w in enumerate(self.words)}

    @cached_property
    def arc_keys(self) -> np.ndarray:
        """State and word of each arc as one integer; they rise, as the arcs of a state are in order."""
        return np.repeat(np.arange(len(self.weight)), self.arcs) * (len(self.words) + 1) + self.label

    def total(self) -> int:
        """Sum of the weights of single words."""
        return int(self.weight[self.target[self.first[-2] :]].sum())

    def part(self, k: int, n: int) -> Automaton:
        """The n-grams whose words' checksums add up to ``k`` modulo ``n``."""
        bits = width_of(len(self.words))
        check = np.asarray([0, *map(zlib.crc32, self.words)], np.int64)
        a, b, c, w = self.ngrams()
        some = (check[a] + check[b] + check[c]) % n == k
        keys, weights = summed(packed(a[some], b[some], c[some], bits), w[some])
        return Automaton.build(self.words, keys, weights, bits)

    def ngrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers (0: none) of all n-grams with a weight, in order of depth, and the weights."""
        path = [np.zeros(1, np.int64)] * WORDS
        at = np.asarray([len(self.weight) - 1])
        found = []
        for depth in range(WORDS):
            size = self.arcs[at]
            arc = _ranges(self.first[at], size)
            path = [np.repeat(x, size) for x in path]
            path[depth] = self.label[arc]
            at = self.target[arc]
            some = self.weight[at] > 0
            found.append((*(x[some] for x in path), self.weight[at][some]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def composed(self, counts: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """N-grams that both accept: word numbers of this one's words, the weight here and the weight there.

        Pairs of states are walked word by word; an arc here meets the arc of the same word there.
        """
        other = np.asarray([0, *(counts.numbers.get(w, 0) for w in self.words)], np.int64)
        step, arc_key = len(counts.words) + 1, counts.arc_keys
        path = [np.zeros(1, np.int64)] * WORDS
        p, q = np.asarray([len(self.weight) - 1]), np.asarray([len(counts.weight) - 1])
        found = []
        for depth in range(WORDS):
            size = self.arcs[p]
            arc = _ranges(self.first[p], size)
            label = self.label[arc]
            key = np.repeat(q, size) * step + other[label]
            place = np.minimum(np.searchsorted(arc_key, key), max(0, len(arc_key) - 1))
            meets = (other[label] > 0) & (arc_key[place] == key) if len(arc_key) else np.zeros(len(key), bool)
            path = [np.repeat(x, size)[meets] for x in path]
            path[depth] = label[meets]
            p, q = self.target[arc[meets]], counts.target[place[meets]]
            both = (self.weight[p] > 0) & (counts.weight[q] > 0)
            found.append((*(x[both] for x in path), self.weight[p][both], counts.weight[q][both]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def dump(self) -> bytes:
        words = b"\n".join(self.words)
        head = struct.pack("<4Q", len(self.words), len(words), len(self.weight), len(self.label))
        body = b"".join((words, *(x.astype(kind).tobytes() for x, kind in ((self.weight, "<i8"), (self.arcs, "<u4"), (self.label, "<u4"), (self.target, "<u4")))))
        return zstandard.ZstdCompressor(level=1).compress(head + body)

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        data = zstandard.ZstdDecompressor().decompress(data)
        n, size, states, arcs = struct.unpack_from("<4Q", data)
        at = 32 + size
        words = data[32:at].split(b"\n") if n else []
        out = []
        for kind, count in (("<i8", states), ("<u4", states), ("<u4", arcs), ("<u4", arcs)):
            out.append(np.frombuffer(data, kind, count, at).astype(np.int64))
            at += out[-1].size * (8 if kind == "<i8" else 4)
        return cls(words, *out)


def united(parts: Iterable[Automaton], least: int = 1) -> tuple[list[bytes], np.ndarray, np.ndarray, int]:
    """Words, n-grams in order and summed weights (from ``least`` on) of several automata, and the bits of a word.

    If they have too many words for one numbering, the n-grams are summed in parts by checksum, and
    those that stay are numbered together.
    """
    parts = list(parts)
    words = set().union(*(x.words for x in parts))
    if len(words) > MOST_WORDS:
        n = 2 * len(words) // MOST_WORDS + 1
        kept = []
        for k in range(n):
            some, keys, weights, bits = united([x.part(k, n) for x in parts], least)
            kept.append(Automaton.build(some, keys, weights, bits))
        return united(kept)
    words = sorted(words)
    bits = width_of(len(words))
    number = {w: i + 1 for i, w in enumerate(words)}
    keys, weights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x in parts:
        mine = np.asarray([0, *(number[w] for w in x.words)], np.int64)
        a, b, c, w = x.ngrams()
        keys.append(packed(mine[a], mine[b], mine[c], bits))
        weights.append(w)
    keys, weights = summed(np.concatenate(keys), np.concatenate(weights))
    often = weights >= least
    return words, keys[often], weights[often], bits
