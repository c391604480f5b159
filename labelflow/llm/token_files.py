"""Token ids in Arrow files of fixed-size-list batches.

Documents are range-partitioned by id, encoded, each closed with an end id, and packed one
after another into sequences of equal length. A partition writes one shard: an uncompressed
Arrow IPC file with columns ``ids`` and ``mask`` (both fixed-size lists of the sequence
length), whose last sequence is padded with mask 0, and an index file with id, first token
and number of tokens of each document. Uncompressed fixed-size lists can be memory-mapped:
sequence i of a batch is a slice, nothing is decoded or copied.

Shards are numbered in id order, nulls first. Files are written under a name of their own
attempt; the manifest names only those of attempts that finished, so a lost executor or a
repeated task leaves at most files that nobody reads. ``folder`` must be a place that driver
and executors share and that pyarrow can open (file, HDFS, S3, GCS).

Null text counts as empty: the end id alone. Repeated rows are written one by one, in the
order of their texts' hashes. An empty table gives no documents. Other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelflow.llm.common import file_bytes, id_text, materialise, parts

SEQUENCE = 2048
BATCH_SEQUENCES = 128
_CACHE = 300_000
#: The splitting of words that ``WordEncoder`` knows, as the tokenizer file states it.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of these characters fold case and split alike in Python and in the tokenizers library.
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
#: ``_SPLIT`` for such texts, lower-cased.
_PLAIN_WORD = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9ß-öø-ÿ]+")


class WordEncoder:
    """Ids of a text by its pre-tokens, as ``tokenizers`` gives them without special tokens.

    Texts of ASCII and Latin letters are split here, if the tokenizer folds case, splits as ``_SPLIT`` says
    and marks the ends of words; others at spaces and line feeds, which every pre-token ends at, and the library
    does the rest. A text that holds an added token as it is written goes to the library whole. A bounded
    number of words is remembered.
    """

    def __init__(self, spec: bytes):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec.decode("utf-8"))
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        told = json.loads(spec)
        self.added = [t["content"].lower() for t in told.get("added_tokens") or ()]
        suffix = told["model"].get("end_of_word_suffix")
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        split = ((told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        folds = [x.get("type") for x in (told.get("normalizer") or {}).get("normalizers") or ()] == ["NFC", "Replace", "Lowercase"]
        self.plain = bool(suffix) and folds and split.get("pattern") == {"Regex": _SPLIT} and split.get("invert") is True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _words(self, text: str | None) -> list[str]:
        """Parts of a text that are encoded separately."""
        if not text:
            return []
        low = text.lower()
        if any(t in low for t in self.added):
            return [text]
        if self.plain and _PLAIN.fullmatch(text):
            return _PLAIN_WORD.findall(low)
        return text.replace("\n", " ").split(" ")

    def _encode_words(self, words: list[str]) -> None:
        """Learns words that are one pre-token each, many to a call; their last tokens tell them apart."""
        for at in range(0, len(words), 1024):
            some = words[at:at + 1024]
            ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype=self.dtype)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some):
                self._encode_one_by_one(some)
                continue
            raw, edges = ids.tobytes(), (stops * self.dtype.itemsize).tolist()
            self.young.update(zip(some, [raw[a:z] for a, z in zip([0, *edges[:-1]], edges, strict=True)], strict=True))

    def _encode_one_by_one(self, pieces: list[str]) -> None:
        for w, e in zip(pieces, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False), strict=True):
            self.young[w] = np.asarray(e.ids, dtype=self.dtype).tobytes()

    def _learn(self, pieces: list[str]) -> None:
        if not self.plain:
            self._encode_one_by_one(pieces)
            return
        whole = [bool(_PLAIN_WORD.fullmatch(p)) for p in pieces]
        self._encode_words([p for p, one in zip(pieces, whole) if one])
        self._encode_one_by_one([p for p, one in zip(pieces, whole) if not one])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        pieces = [self._words(t) for t in texts]
        wanted = set().union(*pieces)
        missing = wanted.difference(self.young)
        if len(self.young) + len(missing) > _CACHE:
            self.old, self.young = self.young, {w: self.young[w] for w in wanted.intersection(self.young)}
        old = self.old
        again = missing.intersection(old)
        self.young.update([(w, old[w]) for w in again])
        self._learn(list(missing.difference(again)))
        get = self.young.__getitem__
        return [b"".join(map(get, p)) for p in pieces]


@lru_cache(maxsize=2)
def _encoder(spec: bytes) -> WordEncoder:
    return WordEncoder(spec)


def _filesystem(folder: str):
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder)


def _schemas(dtype: np.dtype, length: int, key_type: pa.DataType) -> tuple[pa.Schema, pa.Schema]:
    ids = pa.schema([pa.field("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), pa.field("mask", pa.list_(pa.bool_(), length))])
    return ids, pa.schema([("id", key_type), ("first", pa.int64()), ("n_tokens", pa.int64())])


class _ShardWriter:
    """Packs token runs into sequences and writes full batches as they come."""

    def __init__(self, sink, schema: pa.Schema, dtype: np.dtype, length: int):
        self.writer = pa.ipc.new_file(sink, schema)
        self.schema, self.dtype, self.length = schema, dtype, length
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.total = 0

    def add(self, run: bytes) -> None:
        self.waiting.append(run)
        self.waiting_bytes += len(run)
        self.total += len(run) // self.dtype.itemsize
        if self.waiting_bytes >= self.length * BATCH_SEQUENCES * self.dtype.itemsize:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.waiting), dtype=self.dtype)
        if last:
            n = -(-len(flat) // self.length)
        else:  # all batches but the last are full, so that a sequence's batch is known from its number
            n = len(flat) // (self.length * BATCH_SEQUENCES) * BATCH_SEQUENCES
        whole = np.zeros(n * self.length, dtype=self.dtype)
        used = min(len(flat), len(whole))
        whole[:used] = flat[:used]
        mask = np.zeros(len(whole), dtype=bool)
        mask[:used] = True
        for at in range(0, n, BATCH_SEQUENCES):
            a, z = at * self.length, min(n, at + BATCH_SEQUENCES) * self.length
            self.writer.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(whole[a:z]), self.length),
                 pa.FixedSizeListArray.from_arrays(pa.array(mask[a:z]), self.length)], schema=self.schema))
        rest = flat[used:].tobytes()
        self.waiting, self.waiting_bytes = [rest], len(rest)

    def close(self) -> None:
        self._flush(last=True)
        self.writer.close()


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
          length: int = SEQUENCE) -> DataFrame:
    """Writes the shards and returns their manifest (shard, path, n_docs, n_tokens), one row per shard."""
    spec = docs.sparkSession.sparkContext.broadcast(file_bytes(tokenizer_path))
    rows = id_text(docs, id_col, text_col)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(rows.schema["id"].dataType)
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")

    def run(batches):
        enc = _encoder(spec.value)
        schema, index_schema = _schemas(enc.dtype, length, key_type)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        fs, base = _filesystem(folder)
        shard = TaskContext.get().partitionId()
        path = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex[:12]}"
        writer = sink = index = None
        n_docs = 0
        for ids, texts in parts(batches):
            if writer is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(f"{path}.arrow")
                writer = _ShardWriter(sink, schema, enc.dtype, length)
                index_sink = fs.open_output_stream(f"{path}.index.arrow")
                index = pa.ipc.new_file(index_sink, index_schema)
            firsts, sizes = [], []
            for tokens in enc.encode(texts):
                firsts.append(writer.total)
                writer.add(tokens)
                writer.add(end)
                sizes.append(writer.total - firsts[-1])
            index.write_batch(pa.RecordBatch.from_arrays([pa.array(ids, key_type), pa.array(firsts, pa.int64()), pa.array(sizes, pa.int64())],
                                                         schema=index_schema))
            n_docs += len(ids)
        if writer is not None:
            writer.close()
            index.close()
            sink.close()
            index_sink.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "n_docs": n_docs, "n_tokens": writer.total}],
                                             schema=pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    return materialise(ordered.mapInArrow(run, "shard bigint, path string, n_docs bigint, n_tokens bigint"), "token-manifest")


class Shard:
    """Random access to a shard's sequences; local files are memory-mapped."""

    def __init__(self, fs, path: str):
        from pyarrow import fs as pafs

        local = isinstance(fs, pafs.LocalFileSystem)
        self.file = pa.memory_map(path, "r") if local else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.file)
        self.length = self.reader.schema.field("ids").type.list_size

    def tokens(self, first: int, n: int) -> np.ndarray:
        """``n`` tokens from ``first`` on; a copy only where they span batches."""
        per = self.length * BATCH_SEQUENCES
        out, at, end = [], first, first + n
        while at < end:
            batch = self.reader.get_batch(at // per)
            values = batch.column(0).values.to_numpy(zero_copy_only=True)
            out.append(values[at % per:at % per + end - at])
            if not len(out[-1]):
                raise ValueError(f"the shard ends before token {end}")
            at += len(out[-1])
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.empty(0, np.uint16)


def read(manifest: DataFrame, folder: str, id_col: str, id_type: str) -> DataFrame:
    """Per document, from the files: id_col, start (tokens of all documents before it), n_tokens, ids_crc32."""
    # one row per shard: their number, not their content, meets in one task
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("path", F.coalesce(before, F.lit(0)).alias("base"))

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    key_type = to_arrow_type(_parse_datatype_string(id_type))
    out_schema = pa.schema([("id", key_type), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        fs, _ = _filesystem(folder)
        for bases, paths in parts(batches):
            for base, path in zip(bases, paths, strict=True):
                ids = Shard(fs, f"{path}.arrow")
                with fs.open_input_file(f"{path}.index.arrow") as f:
                    index = pa.ipc.open_file(f)
                    for k in range(index.num_record_batches):
                        b = index.get_batch(k)
                        firsts, sizes = b.column(1).to_pylist(), b.column(2).to_pylist()
                        crc = [zlib.crc32(ids.tokens(a, n).astype("<u4").tobytes()) for a, n in zip(firsts, sizes, strict=True)]
                        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([base + a for a in firsts], pa.int64()), b.column(2),
                                                          pa.array(crc, pa.int64())], schema=out_schema)

    # as many tasks as shards
    dealt = shards.repartitionByRange(max(1, manifest.count()), "path")
    return dealt.select("base", "path").mapInArrow(run, f"id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint").withColumnRenamed("id", id_col)
