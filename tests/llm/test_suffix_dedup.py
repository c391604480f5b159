import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from labelflow.llm import queries, suffix_dedup as S
from tests.conftest import SF_SMALL
from tests.llm.conftest import prose, table


def brute(texts, length=S.LENGTH):
    """(n_bytes, removed spans, kept bytes) of each text, by counting every string."""
    texts = [(t or "").encode() for t in texts]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        edge = np.flatnonzero(np.diff(np.concatenate(([0], np.frombuffer(bytes(gone), np.uint8), [0])).astype(int)))
        out.append((len(t), [tuple(x) for x in edge.reshape(-1, 2).tolist()], bytes(b for b, g in zip(t, gone) if not g)))
    return out


def strings(rng, n):
    """Strings of few letters with long common prefixes, some equal, some prefixes of others."""
    base = bytes(rng.randrange(97, 100) for _ in range(300))
    out = []
    for _ in range(n):
        s = bytearray(base[rng.randrange(0, 5):][:rng.randint(0, 250)])
        for _ in range(rng.randint(0, 2)):
            if s:
                s[rng.randrange(len(s))] = rng.randrange(97, 100)
        out.append(bytes(s))
    return out


@pytest.mark.parametrize("shallow", [8, 64, 400])
def test_deep_shallow_sorting(shallow):
    rng = random.Random(shallow)
    for _ in range(80):
        given = strings(rng, rng.randint(1, 60))
        order, common = S.deep_shallow(given, shallow)
        assert [given[i] for i in order] == sorted(given)
        assert common.tolist() == [0] + [S._common(given[a], given[b]) for a, b in zip(order, order[1:])]


def test_blind_trie_alone():
    rng = random.Random(2)
    for _ in range(80):
        given = strings(rng, rng.randint(1, 60))
        assert [given[i] for i, _ in S.blind_trie_order(given, list(range(len(given))))] == sorted(given)


def test_equal_strings_have_anchors_with_equal_grams():
    rng = random.Random(4)
    shared = bytes(rng.randrange(256) for _ in range(S.LENGTH))
    for n in range(0, 400, 37):
        texts = [bytes(rng.randrange(256) for _ in range(n)) + shared + bytes(rng.randrange(256) for _ in range(m)) for m in (0, 5, 300)]
        found = {}
        for i, at, h in S._text_anchors(texts):
            if n <= at <= n + S.BACK:
                found.setdefault(h, set()).add((i, at))
        assert any({i for i, _ in x} == {0, 1, 2} for x in found.values())


def planted(spread=1):
    p, q, r = prose(70, 60), prose(71, 45), prose(72, 28)
    assert len(p) > 300 and len(q) > 200 > len(r)
    edge = prose(73, 200)
    rows = [(1, p), (2, p), (2, p), (3, None), (4, ""), (5, prose(74, 300)), (None, "x " + p + " y"), (6, prose(75, 50) + q + prose(76, 50)), (7, q), (8, prose(77, 40) + r),
            (9, r), (10, edge[:200]), (11, "z" + edge[:200]), (12, edge[300:499]), (13, edge[300:499] + "!"), (14, "ab" * 180), (15, "a" * 199), (16, "é" * 150),
            (17, "Ä" + "é" * 150), (18, " ".join([q, prose(78, 20), q, prose(79, 20), p])), (19, edge[600:850]), (20, edge[610:840] + prose(80, 9)), (21, prose(81, 9) + edge[605:845])]
    # one line between different neighbours, and near copies
    line = prose(82, 40)
    rows += [(100 + k, f"{prose(200 + k, 30)} {line} {prose(300 + k, 30)}") for k in range(40 * spread)]
    words = prose(83, 400).split()
    rows += [(400 + k, " ".join(w if i % 97 != k else "q" for i, w in enumerate(words))) for k in range(20)]
    return rows


def run(df):
    return sorted((r["doc_id"] is None, r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"]), r["n_removed"]) for r in S.deduplicate(df).collect())


def expected(rows):
    return sorted((i is None, i, n, spans, kept, n - len(kept)) for (i, _), (n, spans, kept) in zip(rows, brute([t for _, t in rows])))


def test_planted_and_awkward_rows(spark, awkward):
    rows = [*awkward, *planted()]
    assert run(table(spark, rows)) == expected(rows)


def test_grams_beyond_the_sorting_limit(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 5)
    rows = planted()
    assert run(table(spark, rows)) == expected(rows)


def test_texts_longer_than_a_piece(spark, monkeypatch):
    shared = prose(90, 60)
    a = prose(91, 60_000)
    rows = [(1, a), (2, a[:100_000] + shared + a[100_050:150_000]), (3, prose(92, 9) + shared), (4, "lo " * 30_000)]
    assert len(a) > 300_000
    monkeypatch.setattr(S, "PIECE", 50_000)
    S._powers.cache_clear()
    texts = [(t or "").encode() for _, t in rows]
    pieces = list(S._text_anchors(texts))
    monkeypatch.undo()
    S._powers.cache_clear()
    assert sorted(pieces) == sorted(S._text_anchors(texts))
    assert run(table(spark, rows)) == expected(rows)


def test_anchors_need_little_memory_beside_their_batch():
    texts = [prose(k, 600).encode() for k in range(1200)]
    keys = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([keys, keys, pa.array(texts, pa.binary())], names=["k1", "k2", "text"])
    assert batch.nbytes > 4 << 20
    S._powers.cache_clear()
    tracemalloc.start()
    try:
        n = sum(out.num_rows for out in S._anchor_rows([batch, batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        S._powers.cache_clear()
    # one row an anchor, copies none; pieces of a megabyte took 89 MB
    assert n == len(list(S._text_anchors(texts))) and peak < 32 << 20


def test_no_rows(no_docs):
    out = S.deduplicate(no_docs)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "spans", "kept"] and out.count() == 0


def test_clashing_columns(spark):
    p = prose(70, 60)
    df = spark.createDataFrame([(1, p, 5, 6, 7, "x"), (2, p + " more", 5, 6, 7, "x"), (3, "short", 5, 6, 7, "x")], "doc_id bigint, text string, k1 bigint, h bigint, at int, kept string")
    assert run(df) == expected([(1, p), (2, p + " more"), (3, "short")])


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for (i, _), (n, spans, kept) in zip(rows, brute([t for _, t in rows]))}
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op12_suffix_dedup"](spark, SF_SMALL).collect()}
    assert got == want and sum(x[1] > 0 for x in got.values()) > 0
