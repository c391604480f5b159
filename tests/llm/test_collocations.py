import random
import re
from collections import Counter

import numpy as np
import pytest

from labelflow.llm import automata as A, collocations as C
from tests.llm.conftest import prose, table


def brute(rows, least=10):
    """(lang, phrase) -> (a, l, r, n, score) of all phrases that stay."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                f.update((lang, tuple(w[i:i + size])) for i in range(len(w) - size + 1))
    out = {}
    for (lang, g), a in f.items():
        if len(g) < 2 or a < least:
            continue
        if len(g) == 2 and any(x == lang and len(h) == 3 and g in (h[:2], h[1:]) and b >= least and 100 * b >= 50 * a for (x, h), b in f.items() if len(h) == 3):
            continue
        score, k = min((1_000_000 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
        out[lang, " ".join(g)] = (a, f[lang, g[:k]], f[lang, g[k:]], n[lang], score)
    return out


def found(df):
    rows = [(r["lang"], r["phrase"], (r["a"], r["l"], r["r"], r["n"], r["score"])) for r in df.collect()]
    assert len({x[:2] for x in rows}) == len(rows)
    return {x[:2]: x[2] for x in rows}


def texts(seed, n):
    """Few words, so that phrases repeat; punctuation, case, tabs and languages of all kinds."""
    rng = random.Random(seed)
    words = ["a", "B", "the", "Of", "é", "ü\x1f", "日本", "x\x00y", "q" * 300, *(f"w{i}" for i in range(9))]
    seps = [" "] * 12 + ["\t", "  ", ". ", ", ", "\n", "\x0b", ";", "!?"]
    out = []
    for i in range(n):
        text = "".join(rng.choice(words if rng.random() < 0.7 else words[:4]) + rng.choice(seps) for _ in range(rng.randint(0, 120)))
        out.append((i, text + " new york city" * rng.randint(0, 2), rng.choice(["en", "de", None, "und", ""])))
    return out


def grams(seed):
    rng = random.Random(seed)
    words = [b"w%02d" % i for i in range(rng.randint(1, 12))]
    held = {tuple(rng.choice(words) for _ in range(rng.randint(1, 3))): rng.randint(1, 4) for _ in range(rng.randint(0, 80))}
    return words, held


def automaton(words, held):
    bits = A.width_of(len(words))
    keys = np.asarray([[words.index(w) + 1 for w in g] + [0] * (3 - len(g)) for g in sorted(held)], np.int64).reshape(-1, 3)
    return A.Automaton.build(words, A.packed(*keys.T, bits), np.asarray([held[g] for g in sorted(held)], np.int64), bits)


def read(machine):
    return {tuple(machine.words[i - 1] for i in x if i): int(w) for *x, w in zip(*machine.ngrams())}


def test_automata_keep_their_counts_and_are_minimal():
    for seed in range(60):
        words, held = grams(seed)
        machine = A.Automaton.load(automaton(words, held).dump())
        assert read(machine) == held
        assert machine.total() == sum(w for g, w in held.items() if len(g) == 1)
        states = [(int(w), machine.label[i:i + n].tobytes(), machine.target[i:i + n].tobytes())
                  for w, i, n in zip(machine.weight, machine.first, machine.arcs)][:-1]
        assert len(states) == len(set(states))


def test_union_and_composition():
    for seed in range(60):
        one, two = automaton(*grams(seed)), automaton(*grams(seed + 1000))
        both = Counter(read(one)) + Counter(read(two))
        assert read(A.Automaton.build(*A.united([one, two]))) == both
        assert read(A.Automaton.build(*A.united([one, two], 3))) == {g: w for g, w in both.items() if w >= 3}
        *path, here, there = one.composed(two)
        got = {tuple(one.words[i - 1] for i in x if i): (int(v), int(w)) for *x, v, w in zip(*path, here, there)}
        assert got == {g: (w, read(two)[g]) for g, w in read(one).items() if g in read(two)}


def test_more_words_than_one_numbering_holds(monkeypatch):
    machines = [automaton(*grams(seed)) for seed in range(12)]
    whole = read(A.Automaton.build(*A.united(machines, 9)))
    monkeypatch.setattr(A, "MOST_WORDS", 12)
    extra = A.Automaton.build([b"x%02d" % i for i in range(9)], A.packed(np.arange(1, 10), np.zeros(9, np.int64), np.zeros(9, np.int64), 4), np.ones(9, np.int64), 4)
    assert read(A.Automaton.build(*A.united([*machines, extra], 9))) == whole


@pytest.mark.parametrize("range_bytes, shard_words, segment", [(8 << 20, 10**6, 200_000), (2000, 97, 23), (300, 10**6, 200_000)])
def test_equals_brute_force(spark, monkeypatch, range_bytes, shard_words, segment):
    monkeypatch.setattr(C, "RANGE_BYTES", range_bytes)
    given = texts(3, 120)
    rows = spark.createDataFrame(given, "doc_id int, text string, lang string").repartition(3)
    # tasks read the module's own constants: small shards are tried in this process
    assert found(C.mine(rows)) == brute([(lang, t) for _, t, lang in given])
    monkeypatch.setattr(C, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(C, "SEGMENT", segment)
    assert local(given, C.Ranges(C._bounds(rows.selectExpr("coalesce(lang, 'und') AS lang", "cast(text AS binary) AS text")))) == brute([(lang, t) for _, t, lang in given])


def local(given, ranges):
    """The same steps without Spark: each shuffle is a sort."""
    import pyarrow as pa

    def shuffled(batches, keys):
        rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[:keys])
        kind = [pa.int64() if isinstance(x, int) else pa.binary() if isinstance(x, bytes) else pa.string() for x in rows[0]]
        return [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i:i + 7]), kind)], names=[str(k) for k in range(len(kind))]) for i in range(0, len(rows), 7)]

    docs = pa.RecordBatch.from_arrays([pa.array(["und" if lang is None else lang for _, _, lang in given]), pa.array([t.encode() for _, t, _ in given], pa.binary())], names=["lang", "text"])
    counts = list(C._sum(shuffled(C._count([docs], ranges), 2), 10))
    n = Counter()
    for b in counts:
        for lang, m in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            n[lang] += m
    asked = shuffled(C._ask([b.select(["lang", "range", "data"]) for b in counts], ranges), 4)
    out = {}
    for b in C._score(shuffled(C._answer(asked), 3)):
        for lang, phrase, a, l, r, score in zip(*(c.to_pylist() for c in b.columns)):
            out[lang, phrase] = (a, l, r, n[lang], score)
    return out


def test_products_beyond_64_bits():
    words, held = [b"a", b"b"], {(b"a",): 4 * 10**12, (b"b",): 3 * 10**12, (b"a", b"b"): 2 * 10**12}
    ranges = C.Ranges({})
    import pyarrow as pa
    counts = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([0]), pa.array([automaton(words, held).dump()], pa.binary())], names=["lang", "range", "data"])
    asked = sorted((r for b in C._ask([counts], ranges) for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[:4])
    answers = [b for b in C._answer([C._batch(asked, "lang range kind other data")])]
    scored = next(C._score(answers)).to_pylist()
    assert scored == [{"lang": "en", "phrase": "a b", "a": 2 * 10**12, "l": 4 * 10**12, "r": 3 * 10**12, "score": 333333}]


def test_awkward_rows(spark, awkward):
    a = "new york city. " * 12
    given = [*[(i, t, "en") for i, t in awkward], (50, a, None), (51, a, "en"), (52, None, None), (53, "only. one; word", "de"), (54, prose(5, 100) * 11, "fr")]
    assert found(C.mine(table(spark, given))) == brute([(lang, t) for _, t, lang in given])


def test_first_rows_and_ties(spark):
    text = " ".join(["b c."] * 10 + ["a d."] * 10 + ["e f."] * 20 + ["e."] * 20)
    rows = [tuple(r) for r in C.top(C.mine(table(spark, [(1, text)])), 2).select("lang", "rank", "phrase", "score").orderBy("rank").collect()]
    assert rows == [("en", 1, "a d", 1_000_000), ("en", 2, "b c", 1_000_000)]


def test_no_rows(no_docs):
    out = C.top(C.mine(no_docs))
    assert sorted(out.columns) == ["a", "l", "lang", "n", "phrase", "r", "rank", "score"] and out.count() == 0
