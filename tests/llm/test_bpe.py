import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from labelflow.llm import bpe
from tests.llm.conftest import prose, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        return tiktoken.Encoding("lib", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()), special_tokens={})


def expected(library, rows):
    return Counter((i, np.array(library.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode()) for i, t in rows)


@pytest.mark.parametrize("chunk,overlap", [(1 << 16, 1 << 10), (64, 16), (30, 3), (7, 7)])
def test_same_as_library_at_any_chunk_size(spark, docs, awkward, library, chunk, overlap):
    both = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk_chars=chunk, overlap_chars=overlap), RANKS).collect()
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in both) == expected(library, awkward)
    assert all(r.n_tokens == len(r.ids) // 4 for r in both)


def test_runs_longer_than_the_overlap_and_white_space(spark, library):
    rows = [(1, "a" * 3000), (2, " " * 900 + "x"), (3, ("word  \n " * 300) + "'ll 'S"), (4, "1" * 500 + "abc " * 100), (5, "a" * 3000),
            (6, "\x1c\x85  　x" * 80), (7, prose(5, 400, "   "))]
    out = bpe.encode(table(spark, rows), RANKS, public_tokenizers.PATTERN, chunk_chars=100, overlap_chars=20).collect()
    assert Counter((r.doc_id, bytes(r.ids)) for r in out) == Counter((i, b) for i, b, _ in expected(library, rows).elements())


def test_cuts_at_every_offset_around_blank_lines_and_tabs(spark, library):
    rows = [(100 * n + k, "x" * k + f"foo{gap}bar\t\tend  of{gap}'re 12 {gap}" * 6) for n, gap in enumerate(("\n\n", "\t\t", " \n\n ", "\u3000\n")) for k in range(24)]
    out = bpe.encode(table(spark, rows), RANKS, public_tokenizers.PATTERN, chunk_chars=24, overlap_chars=12).collect()
    assert Counter((r.doc_id, bytes(r.ids)) for r in out) == Counter((i, b) for i, b, _ in expected(library, rows).elements())


def test_empty_table(no_docs):
    assert bpe.decode(bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_query(spark, library):
    from labelflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op2_byte_bpe"](spark, sf).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
