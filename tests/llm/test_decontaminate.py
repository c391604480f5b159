import re
from collections import Counter

import numpy as np

from labelflow.llm import decontaminate as D
from tests.llm.conftest import prose, table

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, window=10):
    spans = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            spans.setdefault(tuple(w[k:k + window]), set()).add("" if item is None else str(item))
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(s) for s in spans}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in spans:
                    hit |= set(range(k, k + size))
                    found |= spans[tuple(w[k:k + size])]
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return Counter(out)


def run(docs, items, **kw):
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in D.contaminated_words(docs, items, **kw).collect())


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_planted_spans_short_items_and_awkward_rows(spark, awkward):
    p, q = prose(50, 40), prose(51, 25)
    pw = p.split()
    items = [(1, p), (2, q), (2, q), (3, "tiny item"), (4, None), (5, " ".join(pw[5:30])), (6, "Five word item right here"), (7, "solo"), (None, prose(52, 12)),
             (8, " ".join(prose(53, 10).split()))]
    rows = [*awkward, (20, "before " + p + " after"), (21, " ".join(["x", *pw[3:13], "y"])), (22, " ".join(["x", *pw[3:12], "y"])),
            (23, q.upper().replace(" ", ", ")), (24, "a TINY, item; solo"), (25, "five word item right"), (26, "five word item right here five word item right here"),
            (27, p + " " + p), (28, prose(52, 12)), (29, "tiny item " * 30), (30, " ".join(pw[-10:])), (31, prose(53, 10)), (32, prose(53, 9))]
    got = run(table(spark, rows), bench(spark, items))
    assert got == brute(rows, items)
    assert sum(1 for r in got if r[2]) >= 9


def test_empty_tables(spark, docs, no_docs, awkward):
    none = bench(spark, [])
    assert run(no_docs, none) == Counter()
    assert run(docs, none) == brute(awkward, [])


def test_winnowing_guarantee():
    rng = np.random.default_rng(3)
    for _ in range(200):
        shared = rng.integers(0, 2**63, 10).astype(np.uint64)
        chosen = []
        for _ in range(2):
            h = np.concatenate([rng.integers(0, 2**63, rng.integers(0, 9)).astype(np.uint64), shared, rng.integers(0, 2**63, 5).astype(np.uint64)])
            g = D.gram_hashes(h, 5)
            chosen.append(set(g[D.winnow(g, 6)[1]].tolist()))
        assert chosen[0] & chosen[1]


def test_query(spark):
    import hashlib

    from labelflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {i: (n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), h > 0) for (i, n, h, x) in brute(rows, items)}
    got = QUERIES["op8_decontaminate"](spark, sf).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and len(got) == len(rows)
