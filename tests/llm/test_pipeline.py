import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as P
from labelflow.llm import bpe
from tests.llm.conftest import prose
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_simhash import brute_fingerprint, groups, near_pairs

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents and planted copies, shared passages, benchmark passages and texts without letters."""
    base = str(tmp_path_factory.mktemp("corpus"))
    items = [(k, prose(500 + k, 30)) for k in range(5)]
    passage = prose(77, 60)
    docs = [(i, prose(i, 120)) for i in range(40)]
    docs += [(100 + k, docs[k][1]) for k in range(4)]  # exact copies
    docs += [(200, prose(50, 400)), (201, prose(50, 400) + " tail"), (202, prose(51, 400))]  # near copies
    docs += [(300 + k, prose(300 + k, 40) + "\n" + passage + "\n" + prose(340 + k, 40)) for k in range(4)]
    docs += [(400 + k, prose(400 + k, 30) + " " + items[k][1] + " " + prose(440 + k, 30)) for k in range(5)]
    docs += [(500, "123 456 !!!"), (501, None), (502, ""), (503, "  \n ")]
    rows = [(i, t, "xx" if i % 2 else "yy", "s", None if t is None else len(t)) for i, t in docs]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, dict(docs), items


def expected(docs, items, language_kept):
    """Stages 2 to 5 by brute force on what stage 1 kept: {doc_id: text}."""
    rows = sorted((i, docs[i]) for i in language_kept)
    left = {}
    for (i, t), gone in zip(rows, brute_lines([t for _, t in rows]), strict=True):
        text = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
        if not gone or text.strip():
            left[i] = text
    fp = {i: brute_fingerprint(t, 3) for i, t in left.items()}
    root = groups(set(fp.values()), near_pairs(set(fp.values()), 2))
    first = {}
    for i in sorted(left):
        first.setdefault(root[fp[i]], i)
    left = {i: left[i] for i in first.values()}
    bad = {i for i, _, hit, _ in brute_hits(list(left.items()), items) if hit}
    return {i: t for i, t in left.items() if i not in bad}


def test_stages_against_brute_force(spark, corpus):
    base, docs, items = corpus
    kept = {r.doc_id for r in P.language_id(spark, spark.read.parquet(f"{base}/documents.parquet"), base).collect()}
    assert kept == {i for i in docs if i < 500}  # only texts without letters go
    want = expected(docs, items, kept)
    assert {100, 101, 102, 103} & set(want) == set() and not any(400 <= i < 410 for i in want) and set(range(40)) <= set(want)
    assert sum(prose(77, 60) in t for t in want.values()) == 1
    with open(P.RANKS, "rb") as f:
        library = tiktoken.Encoding("lib", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()), special_tokens={})
    got = {r.doc_id: r for r in P.run(spark, base).collect()}
    assert set(got) == set(want)
    for i, t in want.items():
        ids = np.array(library.encode_ordinary(t), dtype="<u4").tobytes()
        assert (bytes(got[i].ids), got[i].n_tokens, got[i].ids_sha256) == (ids, len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_all_but_the_last_stage_return_documents(spark, corpus):
    base, _, _ = corpus
    docs = spark.read.parquet(f"{base}/documents.parquet")
    assert 4 <= len(P.STAGES) <= 5
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, base)
        assert out.columns == docs.columns
        lengths = out.selectExpr("count_if(n_chars <> char_length(text))").first()[0]
        assert lengths == 0


def test_empty_documents(spark, corpus):
    base, _, _ = corpus
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, base)
        assert docs.count() == 0


def test_entry_lists_the_pipeline():
    import __spark_entry__ as entry

    assert {"pipeline", *[f"op{n}_" for n in range(1, 11)]} <= {"pipeline", *[q.split("_")[0] + "_" for q in entry.queries()]}
    assert "pipeline" in entry.queries()
