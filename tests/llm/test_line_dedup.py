import random
from collections import Counter

from labelflow.llm import line_dedup as L
from tests.llm.conftest import prose, table


def brute(texts, min_words=50):
    """Line numbers of later copies: every run of lines with enough words that occurred before, by comparing all runs."""
    seen, deleted = set(), []
    for text in texts:
        lines = [(k, x.strip(" \t\n\x0b\f\r"), len(x.split())) for k, x in enumerate((text or "").split("\n"))]
        lines = [x for x in lines if x[1]]
        gone = set()
        for a in range(len(lines)):
            total = 0
            for z in range(a, len(lines)):
                total += lines[z][2]
                if total >= min_words:
                    run = tuple(x[1] for x in lines[a:z + 1])
                    if run in seen:
                        gone |= {x[0] for x in lines[a:z + 1]}
                    seen.add(run)
        deleted.append(sorted(gone))
    return deleted


def check(spark, rows, min_words=50):
    got = L.dedup_rows(table(spark, rows), min_words=min_words).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = Counter()
    for (i, t), gone in zip(order, brute([t for _, t in order], min_words), strict=True):
        lines = (t or "").split("\n")
        want[i, None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), 0 if t is None else len(lines), tuple(gone)] += 1
    assert Counter((r.doc_id, r.text, r["__n_lines"], tuple(r["__deleted"])) for r in got) == want
    return got


def test_awkward_rows(spark, awkward):
    got = check(spark, awkward)
    assert sum(len(r["__deleted"]) for r in got) >= 4
    assert all(r.ids == "y" and r.words == 3 for r in got)


def test_runs_over_several_lines(spark):
    rng = random.Random(8)
    lines = [prose(100 + k, rng.choice([1, 2, 5, 12, 30, 70])) for k in range(25)]
    rows = []
    for i in range(60):
        a = rng.randrange(20)
        own = [prose(1000 + i, 8)] * rng.randrange(3)
        rows.append((i, "\n".join([*own, *lines[a:a + rng.randrange(1, 9)], "", prose(2000 + i, 20), *lines[rng.randrange(20):][:2]])))
    rows += [(100, "\n".join(["same few words"] * 60)), (101, "\n".join(["w"] * 200)), (102, "\n".join(lines)), (103, "\n".join(lines))]
    got = {r.doc_id: r for r in check(spark, rows)}
    assert got[103].text == ""
    check(spark, rows, min_words=3)


def test_short_lines_and_unique_texts_stay(spark):
    rows = [(i, "a common short line\n" + prose(i, 70)) for i in range(20)]
    assert all(not r["__deleted"] for r in check(spark, rows))


def test_empty_table(no_docs):
    assert L.dedup_rows(no_docs).count() == 0


def test_main_path_is_native(spark, docs):
    kept = docs.select(L.F.lit(1).cast("long").alias(L.ROW_ID), L.F.col("doc_id").alias("id"), "text")
    plan = L.later_copies(kept)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark):
    import hashlib

    from labelflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in QUERIES["op7_line_dedup"](spark, sf).collect()}
    for (i, t), gone in zip(rows, brute([t for _, t in rows]), strict=True):
        assert got[i].deleted == ",".join(map(str, gone))
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
        assert got[i].text_sha256 == hashlib.sha256(left.encode()).hexdigest()
