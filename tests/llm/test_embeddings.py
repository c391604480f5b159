import numpy as np
import pytest

from labelflow.llm import embeddings as E

SCHEMA = "vec_id bigint, embedding array<float>, label int, node long, sim double, vec string"


def unit(v):
    a = np.asarray([np.nan if x is None else x for x in v], dtype=np.float64) if v else np.zeros(0)
    return a / np.linalg.norm(a) if len(a) and np.isfinite(a).all() and np.any(a) else None


def brute(rows, threshold=0.93):
    """(id, links, smallest id reachable) of every row, by comparing all pairs."""
    units = [unit(v) for _, v, _ in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, _, a) in enumerate(rows):
        for j in range(i):
            if a is not None and a == rows[j][2] and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]):
                if float(units[i] @ units[j]) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[max(find(i), find(j))] = min(find(i), find(j))
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[find(i)] = min(r[0], smallest.get(find(i), r[0]))
    return sorted(((r[0], links[i], smallest.get(find(i))) for i, r in enumerate(rows)), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, a, 1, 2.0, "x") for i, v, a in rows], SCHEMA)
    got = E.near_duplicates(df, **kw).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


def near(rng, v, size):
    return (np.asarray(v) + size * rng.standard_normal(len(v))).astype(np.float32).tolist()


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = [(i, rng.standard_normal(24).astype(np.float32).tolist(), i % 3) for i in range(240)]
    out += [(1000 + i, near(rng, out[i][1], 0.05), i % 3) for i in range(60)]  # pairs
    hub = rng.standard_normal(24)
    out += [(2000 + i, near(rng, hub, 0.06), 1) for i in range(110)]  # more different copies than a list holds
    out += [(3000 + i, out[7][1], 1) for i in range(9)] + [(3100, (2 * np.asarray(out[7][1])).tolist(), 1)]  # exact and scaled copies
    out += [(4000, out[7][1], None), (4001, None, 1), (4002, [], 1), (4003, [0.0] * 24, 1), (4004, [1.0] * 23 + [float("nan")], 1),
            (4005, [1.0] * 23 + [float("inf")], 1), (4006, [1.0] * 23 + [None], 1), (4007, [1.0] * 3, 1), (4008, [1.0] * 3, 1), (None, out[8][1], 2), (4009, out[9][1], 0),
            (4009, out[9][1], 0), (None, None, None)]
    return out


def test_same_as_all_pairs(spark, rows, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 32)  # the dense component takes several blocks
    assert run(spark, rows) == brute(rows)


def test_few_rows_and_none(spark):
    some = [(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [0.0, 1.0], 1), (4, [1.0, 0.0], 2)]
    assert run(spark, some) == brute(some)
    assert run(spark, []) == []


def test_audit_refuses_low_recall(spark, rows, monkeypatch):
    monkeypatch.setattr(E, "_verified", lambda lists, nodes, threshold: lists.limit(0).selectExpr("a u", "b v"))
    with pytest.raises(RuntimeError, match="recall"):
        run(spark, rows[:320], attempts=1)


def test_query(spark):
    from labelflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    data = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = QUERIES["op6_embedding_dedup"](spark, sf).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(data)


def test_links_between_saturated_families(spark):
    rng = np.random.default_rng(11)
    hub = rng.standard_normal(24)
    out = [(i, near(rng, hub, 0.04), 0) for i in range(160)]  # most of the links, so that a sum hides the others
    a, b = np.linalg.qr(rng.standard_normal((24, 2)))[0].T
    for side, v in enumerate((a, 0.945 * a + np.sqrt(1 - 0.945**2) * b)):
        out += [(1000 + 100 * side + i, near(rng, v, 0.004), 1) for i in range(12)]
    assert run(spark, out) == brute(out)
