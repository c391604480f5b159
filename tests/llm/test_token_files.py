import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from labelflow.llm import token_files as T
from tests.llm.conftest import prose, table

SPEC = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(SPEC)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_files_hold_all_documents_in_order(spark, docs, awkward, library, tmp_path):
    manifest = T.write(docs, SPEC, str(tmp_path), length=64)
    got = T.read(manifest, str(tmp_path), "doc_id", "bigint").collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(i), len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for i, t in awkward for x in [ids_of(library, t)])
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ordered = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda i: (i is not None, i or 0))
    assert sum(m.n_tokens for m in manifest.collect()) == at


def test_shards_are_fixed_size_lists_with_masks(spark, docs, tmp_path):
    for m in T.write(docs, SPEC, str(tmp_path), length=32).collect():
        reader = pa.ipc.open_file(pa.memory_map(f"{m.path}.arrow", "r"))
        assert reader.schema.field("ids").type == pa.list_(pa.uint16(), 32)
        masks = []
        for k in range(reader.num_record_batches):
            b = reader.get_batch(k)
            assert k == reader.num_record_batches - 1 or b.num_rows == T.BATCH_SEQUENCES
            assert b.column(0).values.to_numpy(zero_copy_only=True).flags["OWNDATA"] is False
            masks += b.column(1).values.to_pylist()
        assert sum(masks) == m.n_tokens and masks == [True] * m.n_tokens + [False] * (len(masks) - m.n_tokens)


def test_documents_longer_than_a_batch(spark, library, tmp_path):
    rows = [(k, prose(k, 900)) for k in range(12)]
    manifest = T.write(table(spark, rows), SPEC, str(tmp_path), length=2)
    got = {r.doc_id: r.ids_crc32 for r in T.read(manifest, str(tmp_path), "doc_id", "bigint").collect()}
    assert got == {i: zlib.crc32(np.array(ids_of(library, t), dtype="<u4").tobytes()) for i, t in rows}


def test_word_lookup_is_the_library(library):
    with open(SPEC, "rb") as f:
        enc = T.WordEncoder(f.read())
    texts = ["O'Brien's can't 'll", "ÀÉ's, ok!? naïve...end", "ﬁne ǅ İI ſ K Å", "a b\tc\x1cd\x85e\r\nf", "été", "<|endoftext|> hi<|startoftext|>", "hello <|endoftext|> world", "A <|EndOfText|>", "x<|endoftext|", "don't 'S .\"'s 'tis 'll'll x'", "a\x0bb\x1cc\td\x7fe", "×÷ÀÿÞ ß Schß", "ß. ẞ, µm ª, ½ x² ١٢",
             "日本語 \U0001f600!! a​b", "", "   \n\n ", "Word. word, WORD; (word) word's word'S 'word' a.b,c", "12abc a1 1,000.50 ***&&& $$$"]
    for _ in range(2):
        assert [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_bounded_memory_of_words(library, monkeypatch):
    monkeypatch.setattr(T, "_CACHE", 50)
    with open(SPEC, "rb") as f:
        enc = T.WordEncoder(f.read())
    for seed in range(30):
        text = prose(seed, 40) + " " + prose(seed % 3, 10)
        assert np.frombuffer(enc.encode([text])[0], enc.dtype).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(enc.young) < 400 and len(enc.old) < 400


def test_empty_table(no_docs, tmp_path):
    manifest = T.write(no_docs, SPEC, str(tmp_path))
    assert manifest.count() == 0 and T.read(manifest, str(tmp_path), "doc_id", "bigint").count() == 0


def test_query(spark, library):
    from labelflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op5_token_files"](spark, sf).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = ids_of(library, r.text)
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
