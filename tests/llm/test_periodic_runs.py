import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from labelflow.llm import periodic_runs, queries
from tests.conftest import SF_SMALL
from tests.llm.conftest import table


def brute(words, least=24):
    """All maximal repetitions, period by period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def digests(words):
    """What op13 returns for a text, by brute force."""
    runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    return (len(runs), *best, best[1] * 1000 // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def made(rng):
    """Stretches of repeated words over a few letters, periods inside periods included."""
    letters, out = rng.choice([1, 2, 3, 10]), []
    for _ in range(rng.randint(0, 8)):
        p = rng.randint(1, rng.choice([8, 30, 90]))
        unit = [b"%d" % rng.randrange(letters) for _ in range(p)]
        if rng.random() < 0.4:
            unit = (unit[: max(1, p // 3)] * 9 + [b"z"])[:p]
        out += (unit * 8)[: rng.randint(0, p * rng.choice([1, 3, 4, 6]))]
    return out


def test_equals_brute_force():
    rng = random.Random(7)
    for _ in range(60):
        texts = [made(rng) for _ in range(8)]
        texts.append(texts[0])
        for words, runs in zip(texts, periodic_runs._indexed(texts, 24)):
            assert runs == sorted(brute(words), key=lambda r: (r[0], r[2]))


def test_blocks_of_one_letter_inside_longer_periods():
    for q in (16, 17, 23, 40, 64, 100):
        for left in (q // 2, q - 1, q // 3):
            words = ([b"a"] * left + [b"b"] * (q - left)) * 4
            for cut in (0, 1, 5, q // 2):
                assert periodic_runs._indexed([words[cut:]], 24)[0] == sorted(brute(words[cut:]), key=lambda r: (r[0], r[2]))


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    values = rng.permutation(500)
    tree = periodic_runs.WaveletMatrix(values, 10)
    lo = rng.integers(0, 500, 300)
    hi = np.minimum(500, lo + rng.integers(0, 60, 300))
    x = rng.integers(0, 600, 300)
    expected = [min((v for v in values[a:b] if v >= c), default=-1) for a, b, c in zip(lo, hi, x)]
    assert tree.successor(lo, hi, x).tolist() == expected


def test_rows_of_any_kind(spark, docs, awkward):
    got = sorted((r["doc_id"] is None, r["doc_id"], r["n_words"], r["collapsed"], len(r["runs"]), r["best"]) for r in periodic_runs.find(docs).collect())
    expected = sorted((i is None, i, len((t or "").encode().split()), " ".join(w.decode() for w in (t or "").encode().split())) for i, t in awkward)
    assert [x[:4] for x in got] == expected
    assert all(x[4:] == (0, None) for x in got)


def test_no_rows(no_docs):
    out = periodic_runs.find(no_docs)
    assert out.columns == ["doc_id", "n_words", "runs", "best", "collapsed"] and out.count() == 0


def test_ties_and_collapsed_text(spark):
    text = "x " + "a b c " * 8 + "y " + "d e f " * 8
    row = periodic_runs.find(table(spark, [(1, text)])).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 24, 3), (26, 24, 3)]
    assert tuple(row["best"]) == (1, 24, 3)
    assert row["collapsed"] == "x a b c y d e f"


def test_unicode_space_belongs_to_a_word(spark):
    row = periodic_runs.find(table(spark, [(1, "a b c\x1fd e\x0bf")])).first()
    assert row["n_words"] == 3 and row["collapsed"] == "a b c\x1fd e f"


def test_long_texts_take_seconds():
    rng = random.Random(1)
    began = time.time()
    for words in ([b"a"] * 400_000, ([b"a"] * 1000 + [b"b"] * 1000) * 150, [b"%d" % rng.randrange(9000) for _ in range(100_000)] * 4):
        assert periodic_runs._indexed([words], 24)[0]
    assert time.time() - began < 40


def test_shorter_runs_are_refused(docs):
    with pytest.raises(ValueError):
        periodic_runs.find(docs, least=10)


def test_query_equals_brute_force(spark):
    sf_dir = SF_SMALL
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for key, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(key).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        expected[key] = digests(words)
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert got == expected
    assert sum(x[0] > 0 for x in got.values()) > 0
