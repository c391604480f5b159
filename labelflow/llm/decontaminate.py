"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words. From every window of ``w`` consecutive
k-grams the smallest hash (the rightmost on ties) becomes a fingerprint. Equal windows of
``k + w - 1`` words choose the same k-gram, so every shared span of that many words shares
a fingerprint. Fingerprints of documents and benchmark are joined and each hit is extended
to both sides on the words themselves. An item with fewer words than the window is one
k-gram of its own length.

Documents only send on fingerprints found in a bitmap of the benchmark's hashes, whose size
is fixed (2 MB) for a benchmark of any size; the join itself is Spark's and exact.

Null texts have no words; they and empty texts are clean rows. A null item_id counts as the
empty string. Repeated document rows are judged one by one; repeated items count once. An
empty benchmark leaves all documents clean. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import ROW_ID, field, materialise, numbered, parts

K = 5
BITMAP_BITS = 24
_PRIME = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _fold_table() -> bytes:
    """Byte map: A-Z to a-z; digits, letters and bytes from 0x80 are word bytes, the rest become spaces."""
    out = bytearray(b" " * 256)
    for b in range(256):
        c = chr(b)
        if "A" <= c <= "Z":
            out[b] = ord(c.lower())
        elif "a" <= c <= "z" or "0" <= c <= "9" or b >= 0x80:
            out[b] = b
    return bytes(out)


FOLD = _fold_table()


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


class _WordHash(dict):
    """Word to 64-bit hash, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 7)
        return h


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; the length takes part."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    g = np.full(n, k, np.uint64)
    for j in range(k):
        g = g * np.uint64(_PRIME) + h[j:j + n]
    g ^= g >> np.uint64(31)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    return g ^ (g >> np.uint64(29))


def winnow(g: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts and the position each window of w hashes chooses."""
    n = len(g) - w + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.arange(n)
    best, at = g[:n].copy(), starts.copy()
    for j in range(1, w):
        here = g[j:j + n]
        take = here <= best
        best[take] = here[take]
        at[take] = starts[take] + j
    return starts, at


def _fingerprints(texts: list, window: int, k: int, lengths: list[int], bitmap: np.ndarray | None, hashes: _WordHash):
    """Per text: number of words and [(hash, position, k, words around)]; full windows use k, other lengths themselves."""
    words = [words_of(t) for t in texts]
    sizes = np.array([len(x) for x in words], dtype=np.int64)
    flat = [x for doc in words for x in doc]
    h = np.fromiter(map(hashes.__getitem__, flat), dtype=np.uint64, count=len(flat))
    ends = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    first = np.cumsum(sizes) - sizes
    found: list[list] = [[] for _ in words]
    w, side = window - k + 1, window - k
    for size, wide in [(k, True)] + [(n, False) for n in lengths]:
        g = gram_hashes(h, size)
        if wide:
            starts, at = winnow(g, w)
            at = at[starts + window <= ends[starts]] if len(starts) else at
        else:
            at = np.arange(len(g))
            at = at[at + size <= ends[at]] if len(at) else at
        if bitmap is not None and len(at):
            at = at[bitmap[(g[at] >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)]]
        reach = side if wide else 0
        for p in np.unique(at).tolist():
            d = int(owner[p])
            lo, hi = max(int(first[d]), p - reach), min(int(ends[p]), p + size + reach)
            found[d].append({"hash": int(g[p].astype(np.int64)), "pos": p - int(first[d]), "k": size,
                             "before": b" ".join(flat[lo:p]).decode("utf-8", "surrogatepass"),
                             "gram": b" ".join(flat[p:p + size]).decode("utf-8", "surrogatepass"),
                             "after": b" ".join(flat[p + size:hi]).decode("utf-8", "surrogatepass")})
    return sizes.tolist(), found


_FP = "array<struct<hash:bigint,pos:int,k:int,before:string,gram:string,after:string>>"
_FP_ARROW = pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int32()), ("k", pa.int32()),
                                ("before", pa.string()), ("gram", pa.string()), ("after", pa.string())]))


def _benchmark(items: DataFrame, window: int, k: int) -> DataFrame:
    """(item, hash, k, before, gram, after) of the benchmark's fingerprints, each different one once."""
    def run(batches):
        hashes = _WordHash()
        for ids, texts in parts(batches, 64):
            out = []
            for text in texts:
                n = len(words_of(text))
                short = [n] if 0 < n < window else []
                _, (fps,) = _fingerprints([text], window, k, short, None, hashes)
                out.append([f for f in fps if (f["k"] == n if short else f["k"] == k)])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, _FP_ARROW)], ["item", "fps"])

    rows = items.select(F.coalesce(items["item"].cast("string"), F.lit("")).alias("item"), "text")
    # a short item and a full one may both have grams of k words: the reach tells them apart
    return (rows.mapInArrow(run, f"item string, fps {_FP}").select("item", F.inline("fps"))
            .withColumn("whole", (F.col("before") == "") & (F.col("after") == ""))
            .select("item", "hash", "k", "before", "gram", "after", "whole").distinct())


def _bitmap(bench: DataFrame) -> np.ndarray:
    """One bool per value of the leading bits of the benchmark's hashes; fixed size whatever the benchmark."""
    lead = F.shiftrightunsigned("hash", 64 - BITMAP_BITS)
    words = (bench.select(lead.alias("b")).groupBy(F.shiftright("b", 5).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 32 as int))")).alias("bits")))
    out = np.zeros((1 << BITMAP_BITS) // 32, dtype=np.uint32)
    for word, bits in words.collect():  # at most 2^24 / 32 rows
        out[word] = bits
    return out


def contaminated_words(docs: DataFrame, items: DataFrame, window: int = 10, k: int = K, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Per document row: id_col, n_words, n_hit (words inside a shared window), items (sorted ids of such items), __row_id.

    ``row_col`` names a column of unique longs to return as __row_id; no other column is taken for one.
    """
    if not 0 < k <= window:
        raise ValueError("k must lie between 1 and window")
    spark = docs.sparkSession
    bench = materialise(_benchmark(items.select(items[item_col].alias("item"), items[item_text_col].cast("string").alias("text")),
                                   window, k), "bench-fingerprints")
    lengths = sorted(r[0] for r in bench.where("whole").select("k").distinct().collect())  # at most ``window`` values
    bitmap = spark.sparkContext.broadcast(_bitmap(bench))
    rows = numbered(docs, id_col, text_col, row_col)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(rows.schema["id"].dataType)

    def run(batches):
        hashes = _WordHash()
        bits = np.unpackbits(bitmap.value.view(np.uint8), bitorder="little").view(bool)
        for rid, ids, texts in parts(batches):
            n, fps = _fingerprints(texts, window, k, lengths, bits, hashes)
            yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(ids, key_type), pa.array(n, pa.int64()),
                                              pa.array(fps, _FP_ARROW)], [ROW_ID, "id", "n_words", "fps"])

    seen = materialise(rows.mapInArrow(run, f"{ROW_ID} bigint, {field('id', rows, 'id')}, n_words bigint, fps {_FP}"),
                       "doc-fingerprints")
    hits = seen.where(F.size("fps") > 0).select(ROW_ID, F.inline("fps"))
    d, b = hits.alias("d"), bench.alias("b")

    def words(c):
        return F.filter(F.split(c, " "), lambda x: x != "")

    def shared(x, y):
        """Number of leading words two arrays share."""
        pairs = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)))
        return F.coalesce(F.array_position(pairs, False) - 1, F.size(pairs)).cast("int")

    def run_length(x, y):
        n = shared(x, y)
        return F.when(n < 0, F.least(F.size(x), F.size(y))).otherwise(n)

    left = run_length(F.reverse(words("d.before")), F.reverse(words("b.before")))
    right = run_length(words("d.after"), words("b.after"))
    matched = (d.join(b, (F.col("d.hash") == F.col("b.hash")) & (F.col("d.gram") == F.col("b.gram")))
               .select(F.col(f"d.{ROW_ID}").alias(ROW_ID), "b.item", F.col("d.pos").alias("pos"), F.col("d.k").alias("k"),
                       F.col("b.whole").alias("whole"), left.alias("l"), right.alias("r"))
               .where(F.col("whole") | (F.col("l") + F.col("k") + F.col("r") >= window))
               .withColumn("l", F.when(F.col("whole"), 0).otherwise(F.col("l")))
               .withColumn("r", F.when(F.col("whole"), 0).otherwise(F.col("r"))))
    matched = materialise(matched, "winnow-hits")
    n_hit = (matched.select(ROW_ID, (F.col("pos") - F.col("l")).alias("a"), (F.col("pos") + F.col("k") + F.col("r") - 1).alias("z"))
             .distinct().select(ROW_ID, F.explode(F.sequence("a", "z")).alias("at")).distinct()
             .groupBy(ROW_ID).agg(F.count("*").alias("n_hit")))
    found = (matched.select(ROW_ID, "item").distinct().groupBy(ROW_ID)
             .agg(F.array_sort(F.collect_list("item")).alias("items")))
    return (seen.select(ROW_ID, "id", "n_words").join(n_hit, ROW_ID, "left").join(found, ROW_ID, "left")
            .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col(ROW_ID)))
