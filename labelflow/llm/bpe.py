"""Byte-level BPE encoding and decoding by overlapping chunks.

Texts up to ``chunk_chars`` are one chunk and are encoded where they are read. A longer
text is cut into chunks that overlap; chunks are pre-tokenised independently, neighbours
are stitched at the first pre-token boundary both of them saw in their overlap, and the
stitched spans are encoded. Pre-tokenising is a left-to-right scan without memory, so two
scans that share a boundary agree from there on. No seam follows white space, whose pre-token
depends on the next character, or lies in the last ``LOOKAHEAD`` characters of a chunk, where a
pre-token may be cut short. A text with a seam that has no shared boundary (a single run longer
than the overlap) is encoded whole.

Null text counts as empty: no ids. Repeated rows give repeated rows. An empty table gives
an empty result. Only the id and text columns are read; other columns are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from labelflow.llm.common import field, file_bytes, id_text, materialise, parts

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
LOOKAHEAD = 4


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


@lru_cache(maxsize=2)
def _encoding(data: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=parse_ranks(data), special_tokens={})


@lru_cache(maxsize=2)
def _vocabulary(data: bytes) -> list[bytes]:
    ranks = parse_ranks(data)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


@lru_cache(maxsize=2)
def _pretokens(pattern: str):
    import regex

    # the rank files' white space is Unicode's; Python's \s also has the separators U+001C..1F
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


@lru_cache(maxsize=1)
def _white():
    import regex

    return regex.compile(r"\p{White_Space}")


def _ids(encoding, text: str) -> bytes:
    return np.asarray(encoding.encode_ordinary(text), dtype="<u4").tobytes()


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """(id_col, ids binary, n_tokens long) per row; ids are little-endian unsigned 32-bit integers."""
    if not 0 < overlap_chars <= chunk_chars:
        raise ValueError("overlap_chars must lie between 1 and chunk_chars")
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(file_bytes(ranks_path))
    rows = id_text(docs, id_col, text_col)

    def encode_whole(batches):
        enc = _encoding(ranks.value, pattern)
        for key, text in parts(batches):
            ids = [_ids(enc, t or "") for t in text]
            yield pa.RecordBatch.from_arrays([pa.array(key, type=key_type), pa.array(ids, pa.binary())], ["id", "ids"])

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(rows.schema["id"].dataType)
    is_long = F.char_length("text") > chunk_chars
    short = rows.where(F.coalesce(~is_long, F.lit(True))).mapInArrow(encode_whole, f"{field('id', rows, 'id')}, ids binary")
    long_rows = rows.where(is_long).select("id", F.sha2(F.col("text"), 256).alias("key"), "text")
    long_ids = _encode_long(long_rows, ranks, pattern, chunk_chars, overlap_chars)
    joined = long_rows.select("id", "key").join(long_ids, "key").select("id", "ids")
    out = short.unionByName(joined)
    return out.select(F.col("id").alias(id_col), "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"))


def _encode_long(rows: DataFrame, ranks, pattern: str, size: int, overlap: int) -> DataFrame:
    """(key, ids) of each distinct long text; copies are encoded once."""
    texts = rows.groupBy("key").agg(F.first("text").alias("text"))
    chunks = (texts.select("key", "text", F.explode(F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / size).cast("int"))).alias("k"))
              .select("key", "k", F.substring("text", F.col("k") * size + 1, F.lit(size + overlap)).alias("piece"))
              .repartition("key", "k"))

    def pretokenise(batches):
        pat, white = _pretokens(pattern), _white()
        for key, k, piece in parts(batches, 16):
            heads, tails = [], []
            for n, text in zip(k, piece, strict=True):
                starts = np.fromiter((m.start() for m in pat.finditer(text)), dtype=np.int64)
                heads.append((starts[starts <= overlap] + n * size).tolist())
                tails.append([s + n * size for s in starts[(starts >= size) & (starts <= len(text) - LOOKAHEAD)].tolist() if not white.match(text, s - 1)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.string()), pa.array(k, pa.int32()), pa.array(piece, pa.string()),
                 pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                ["key", "k", "piece", "heads", "tails"])

    seen = chunks.mapInArrow(pretokenise, "key string, k int, piece string, heads array<bigint>, tails array<bigint>")
    order = Window.partitionBy("key").orderBy("k")  # the chunks of one text
    seam = F.array_min(F.array_intersect(F.lag("tails").over(order), "heads"))
    stitched = (seen.withColumn("first", F.when(F.col("k") == 0, F.lit(0).cast("long")).otherwise(seam))
                .withColumn("more", F.lead("k").over(order).isNotNull())
                .withColumn("last", F.lead("first").over(order))
                .drop("heads", "tails"))

    def encode_spans(batches):
        enc = _encoding(ranks.value, pattern)
        for key, k, piece, first, more, last in parts(batches, 16):
            ids = []
            for n, text, a, m, b in zip(k, piece, first, more, last, strict=True):
                broken = a is None or (m and b is None)
                ids.append(None if broken else _ids(enc, text[a - n * size:(b - n * size) if m else None]))
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(k, pa.int32()), pa.array(ids, pa.binary())],
                                             ["key", "k", "ids"])

    def join_spans(batches):
        for key, spans in parts(batches, 16):
            ids = [b"".join(s["ids"] for s in sorted(x, key=lambda s: s["k"])) for x in spans]
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(ids, pa.binary())], ["key", "ids"])

    spans = materialise(stitched.mapInArrow(encode_spans, "key string, k int, ids binary"), "bpe-spans")
    broken = spans.where("ids is null").select("key").distinct()
    joined = (spans.join(broken, "key", "left_anti").groupBy("key").agg(F.collect_list(F.struct("k", "ids")).alias("spans"))
              .mapInArrow(join_spans, "key string, ids binary"))

    def encode_keyed(batches):
        enc = _encoding(ranks.value, pattern)
        for key, text in parts(batches, 16):
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array([_ids(enc, t) for t in text], pa.binary())],
                                             ["key", "ids"])

    whole = texts.join(broken, "key", "left_semi").select("key", "text").mapInArrow(encode_keyed, "key string, ids binary")
    return joined.unionByName(whole)


def decode(tokens: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``tokens`` with ``out_col``: the raw bytes of its ids, one after another; null ids give null.

    An id outside the ranks raises. A column of ``tokens`` called ``out_col`` is replaced.
    """
    ranks = tokens.sparkSession.sparkContext.broadcast(file_bytes(ranks_path))
    keep = [c for c in tokens.columns if c != out_col]
    src = tokens.select(*keep)
    at = keep.index(ids_col)
    schema = T.StructType([*src.schema.fields, T.StructField(out_col, T.BinaryType())])

    def run(batches):
        table = _vocabulary(ranks.value)
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                piece = batch.slice(s, 256)
                get = table.__getitem__
                out = [None if x is None else b"".join(map(get, np.frombuffer(x, "<u4").tolist()))
                       for x in piece.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(out, pa.binary())], [*keep, out_col])

    return src.mapInArrow(run, schema)
