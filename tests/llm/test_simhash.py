import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from labelflow.llm import simhash as S
from labelflow.llm.common import ROW_ID
from labelflow.llm.components import connected_components
from tests.llm.conftest import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text, shingle):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    s = [" ".join(w)] if 0 < len(w) < shingle else [" ".join(w[k:k + shingle]) for k in range(len(w) - shingle + 1)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_pairs(fps, bits):
    return [(a, b) for a, b in combinations(fps, 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= bits]


def test_awkward_rows(spark, docs, awkward):
    got = S.near_duplicates(docs, shingle=3).collect()
    fp = {i: brute_fingerprint(t, 3) for i, t in awkward}
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(i), f"{fp[i]:016x}") for i, _ in awkward)
    root = groups(set(fp.values()), near_pairs(set(fp.values()), 2))
    smallest = {}
    for i, f in fp.items():
        if i is not None:
            smallest[root[f]] = min(i, smallest.get(root[f], i))
    assert all(r.component_id == smallest.get(root[int(r.fingerprint, 16)]) for r in got)
    assert sum(r.keep for r in got) == len(set(root.values()))
    assert {r.doc_id for r in got if r.component_id == 2} == {2, 3, 4}  # null, empty and blank


def test_empty_table(no_docs):
    assert S.near_duplicates(no_docs).count() == 0


def test_rows_without_any_id(spark):
    out = S.near_duplicates(table(spark, [(None, "a b c d"), (None, "a b c d"), (None, "q r s t")]), shingle=3).collect()
    assert sum(r.keep for r in out) == 2 and {r.component_id for r in out} == {None}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bits", [0, 2])
def test_links_of_sparse_dense_and_chained_fingerprints(spark, bits):
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    fps = {rng.getrandbits(64) for _ in range(400)}
    fps |= {f ^ (1 << rng.randrange(64)) for f in list(fps)[:60]}
    fps |= {f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in list(fps)[60:120]}
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)}  # dense: within 4 bits of each other
    chain = centre ^ 0xFFFF0000FFFF
    for k in range(0, 40, 2):  # neighbours differ by two bits, ends by many
        chain ^= 3 << k
        fps.add(chain)
    fps = {signed(f) for f in fps}
    table_ = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    edges = S.links(table_, bits).collect()
    want = groups(fps, near_pairs(fps, bits))
    got = groups(fps, [(r.u, r.v) for r in edges])
    assert got == want
    assert len(edges) < 65 * len(fps)


def test_thresholds_cover_the_distance():
    """General pigeonhole: the chosen thresholds always sum to the distance less the partitions plus one."""
    rng = np.random.default_rng(1)
    fps = rng.integers(-2**63, 2**63 - 1, 500)
    groups_ = [list(range(k, 64, 3)) for k in range(3)]
    sketch = rng.integers(0, 50, (3, 1 << S.SKETCH_BITS))
    for bits in (0, 2, 4):
        chosen, cost = S.choose_thresholds(fps, groups_, sketch, bits)
        assert (chosen.sum(axis=1) == bits - 2).all() and (chosen >= -1).all() and np.isfinite(cost).all()


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (5000, 64)).astype(float)
    x[:, 40] = x[:, 3]
    x[:, 41] = x[:, 3]
    out = S.group_bits(x.T @ x, len(x))
    assert sorted(sum(out, [])) == list(range(64))
    assert any({3, 40, 41} <= set(g) for g in out)


def test_components_of_long_chains_hubs_and_noise(spark):
    edges = [(k, k + 1) for k in range(0, 300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(5000, 5000), (None, 3), (2, 1), (2, 1)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(301)}, **{1000 + k: 1000 for k in range(400)}}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query(spark):
    from labelflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    fp = {r.doc_id: brute_fingerprint(r.text, 3) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    root = groups(set(fp.values()), near_pairs(set(fp.values()), 2))
    first = {}
    for i in sorted(fp):
        first.setdefault(root[fp[i]], i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, sf).collect()}
    assert got == {i: (f"{f:016x}", first[root[f]]) for i, f in fp.items()}
    assert ROW_ID not in QUERIES["op10_simhash"](spark, sf).columns
