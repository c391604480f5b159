"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are 64-bit SimHashes of word shingles. Different fingerprints within
``max_bits`` bits are linked; equal ones are one node. With m bit partitions and thresholds
T_i that sum to max_bits - m + 1 (each at least -1), two fingerprints within max_bits differ
by at most T_i bits in some partition i. Bits that go together across the corpus are put into
one partition; for each fingerprint a dynamic programme picks the cheapest thresholds from
estimated candidate counts; the values within T_i of its own are probed and candidates verified.

A fingerprint whose cheapest plan would meet more candidates than it has variants of half the
distance is in a dense region. Such fingerprints are linked among themselves through their
variants instead: two are within max_bits exactly if they share a variant, and a variant's group
is bounded by the number of variants. So the work is linear in the number of fingerprints
whatever the size of a group of copies, and no link is lost.

A null, empty or blank text has fingerprint zero and links like any other. Repeated rows share
a fingerprint; null ids are never the smallest. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import ROW_ID, field, materialise, numbered, parts
from labelflow.llm.components import connected_components

BITS = 64
PARTITIONS = 3
SKETCH_BITS = 16
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = _UPPER.lower()
_TABLE = bytes.maketrans(_UPPER, _LOWER)


def shingle_hashes(text: str | None, shingle: int, seed: int) -> list[int]:
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(line, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.empty(len(words) - shingle + 1, dtype=np.int64)
    starts[0] = 0
    starts[1:] = ends[:-shingle] + 1
    h = xxhash.xxh64_intdigest
    return [h(line[a:z], seed) for a, z in zip(starts.tolist(), ends[shingle - 1:].tolist(), strict=True)]


def fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """Bit b is one if more than half of the shingle hashes have it; signed 64-bit."""
    hashes = shingle_hashes(text, shingle, seed)
    if not hashes:
        return 0
    a = np.array(hashes, dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for s in range(0, len(a), 8192):
        ones += np.unpackbits(a[s:s + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(a), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, seed: int, id_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    """(row id, id, fp) per row."""
    rows = numbered(docs, id_col, text_col, row_col)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(rows.schema["id"].dataType)

    def run(batches):
        for rid, ids, texts in parts(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid, pa.int64()), pa.array(ids, key_type),
                 pa.array([fingerprint(t, shingle, seed) for t in texts], pa.int64())], [ROW_ID, "id", "fp"])

    return rows.mapInArrow(run, f"{ROW_ID} bigint, {field('id', rows, 'id')}, fp bigint")


# --- partitions, thresholds and probes ---------------------------------------------------

def _together(fps: DataFrame) -> tuple[np.ndarray, int]:
    """64 x 64 counts of bits that are one together over all fingerprints, and their number."""
    def run(batches):
        total = np.zeros((BITS, BITS))
        for batch in batches:
            a = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            x = np.unpackbits(a.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += x.T @ x
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([float(len(a))])], ["cell", "n"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS), pa.int32()), pa.array(total.ravel())], ["cell", "n"])

    out, n = np.zeros(BITS * BITS), 0
    for cell, v in fps.select("fp").mapInArrow(run, "cell int, n double").groupBy("cell").agg(F.sum("n")).collect():
        if cell < 0:
            n = int(v)
        else:
            out[cell] = v
    return out.reshape(BITS, BITS), n


def group_bits(together: np.ndarray, n: int, parts_: int = PARTITIONS) -> list[list[int]]:
    """Bits dealt into equal partitions, each grown by the bit most correlated with it."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, out = list(range(len(p))), []
    for k in range(parts_):
        size = len(left) // (parts_ - k)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            b = max(left, key=lambda x: (corr[x, group].sum(), -x))
            group.append(b)
            left.remove(b)
        out.append(sorted(group))
    return out


def project(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    u = fps.astype("<i8").view(np.uint64)
    out = np.zeros(len(u), dtype=np.int64)
    for j, b in enumerate(bits):
        out |= ((u >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << j
    return out


def _flips(width: int, radius: int) -> np.ndarray:
    """XOR masks of all values exactly ``radius`` bits away."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], dtype=np.int64)


def _bucket(values: np.ndarray) -> np.ndarray:
    return ((values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def choose_thresholds(fps: np.ndarray, groups: list[list[int]], sketch: np.ndarray, max_bits: int):
    """Cheapest thresholds of each fingerprint (rows x partitions) and their cost.

    Cost of threshold t in a partition: probes plus estimated candidates; -1 skips the partition.
    The sketch only ever counts too much, so the estimate bounds the candidates from above.
    """
    m, n = len(groups), len(fps)
    cost = np.zeros((m, max_bits + 2, n))
    for i, bits in enumerate(groups):
        v = project(fps, bits)
        for t in range(max_bits + 1):
            masks = _flips(len(bits), t)
            est = np.zeros(n)
            for at in range(0, len(masks), 64):
                est += sketch[i][_bucket(v[:, None] ^ masks[None, at:at + 64])].sum(axis=1)
            cost[i, t + 1] = cost[i, t] + est + len(masks)
    # best[s] after i partitions: thresholds so far sum to s - m
    target = max_bits - m + 1
    width = m + max_bits * m + 1
    best = np.full((width, n), np.inf)
    best[m] = 0
    back = np.zeros((m, width, n), dtype=np.int8)
    for i in range(m):
        step = np.full((width, n), np.inf)
        for s in range(width):
            for t in range(-1, max_bits + 1):
                if 0 <= s - t < width:
                    c = best[s - t] + cost[i, t + 1]
                    better = c < step[s]
                    step[s][better] = c[better]
                    back[i, s][better] = t
        best = step
    chosen = np.zeros((n, m), dtype=np.int8)
    s = np.full(n, m + target)
    total = best[m + target]
    for i in range(m - 1, -1, -1):
        chosen[:, i] = back[i, s, np.arange(n)]
        s = s - chosen[:, i]
    return chosen, total


def _sketch(fps: DataFrame, groups: list[list[int]]) -> np.ndarray:
    """Counts of all fingerprints by partition and hashed value; size fixed by SKETCH_BITS."""
    def run(batches):
        total = np.zeros((len(groups), 1 << SKETCH_BITS), dtype=np.int64)
        for batch in batches:
            a = batch.column(0).to_numpy(zero_copy_only=False)
            for i, bits in enumerate(groups):
                np.add.at(total[i], _bucket(project(a, bits)), 1)
        flat = total.ravel()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at], pa.int64())], ["cell", "n"])

    out = np.zeros(len(groups) << SKETCH_BITS, dtype=np.int64)
    counts = fps.select("fp").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out[counts.column("cell").to_numpy()] = counts.column("n").to_numpy()
    return out.reshape(len(groups), -1)


def _variants(max_bits: int) -> list[int]:
    """XOR masks within half the distance (rounded up), as signed 64-bit numbers."""
    half = (max_bits + 1) // 2
    masks = [sum(1 << b for b in c) for r in range(half + 1) for c in combinations(range(BITS), r)]
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def links(fps: DataFrame, max_bits: int, partitions: int = PARTITIONS) -> DataFrame:
    """Edges (u, v) between different fingerprints of ``fps`` (fp, each once) whose components are those of
    all pairs within ``max_bits``. Every edge is such a pair, or joins two ends of a path of such pairs."""
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits must be even: two variants of half an odd distance can be a bit too far apart")
    spark = fps.sparkSession
    together, n = _together(fps)
    groups = group_bits(together, n, partitions)
    sketch = spark.sparkContext.broadcast(_sketch(fps, groups))
    masks = _variants(max_bits)
    dense_cost = len(masks)

    def plan(batches):
        """One row per index entry (probe false) and probe (true) of each fingerprint; part -1: dense."""
        flips = [[np.concatenate([_flips(len(g), r) for r in range(t + 1)]) for t in range(max_bits + 1)] for g in groups]
        for batch in batches:
            everything = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for s in range(0, len(everything), 1024):
                a = everything[s:s + 1024]
                chosen, cost = choose_thresholds(a, groups, sketch.value, max_bits)
                # estimates count the fingerprint itself, once in every partition it probes
                dense = cost - (chosen >= 0).sum(axis=1) > dense_cost
                fp, part, value, probe = [a[dense]], [np.full(int(dense.sum()), -1)], [a[dense]], [np.ones(int(dense.sum()), bool)]
                for i, bits in enumerate(groups):
                    v = project(a, bits)
                    fp.append(a), part.append(np.full(len(a), i)), value.append(v), probe.append(np.zeros(len(a), bool))
                    for t in range(max_bits + 1):
                        on = (chosen[:, i] == t) & ~dense
                        x = flips[i][t]
                        fp.append(np.repeat(a[on], len(x)))
                        value.append((v[on][:, None] ^ x[None, :]).ravel())
                        part.append(np.full(int(on.sum()) * len(x), i))
                        probe.append(np.ones(int(on.sum()) * len(x), bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(fp), pa.int64()), pa.array(np.concatenate(part), pa.int32()),
                     pa.array(np.concatenate(value), pa.int64()), pa.array(np.concatenate(probe), pa.bool_())],
                    ["fp", "part", "value", "probe"])

    rows = materialise(fps.select("fp").mapInArrow(plan, "fp bigint, part int, value bigint, probe boolean"), "gph-rows")
    q, d = rows.where("probe and part >= 0").alias("q"), rows.where("not probe").alias("d")
    near = F.bit_count(F.col("q.fp").bitwiseXOR(F.col("d.fp"))) <= max_bits
    found = (q.join(d, (F.col("q.part") == F.col("d.part")) & (F.col("q.value") == F.col("d.value"))
                    & (F.col("q.fp") != F.col("d.fp")) & near)
             .select(F.col("q.fp").alias("u"), F.col("d.fp").alias("v")))
    spread = (rows.where("part = -1")
              .select("fp", F.explode(F.transform(F.array(*[F.lit(x) for x in masks]), lambda x: x.bitwiseXOR(F.col("fp")))).alias("x")))
    star = (spread.groupBy("x").agg(F.min("fp").alias("u"), F.collect_list("fp").alias("all"))
            .where(F.size("all") > 1).select("u", F.explode("all").alias("v")).where("u <> v").distinct())
    return found.unionByName(star)


def near_duplicates(docs: DataFrame, shingle: int = 5, max_bits: int = 2, seed: int = 42, id_col: str = "doc_id",
                    text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Per row: id_col, fingerprint (hex), component_id (smallest id reachable), __row_id, keep (one row per component).

    ``row_col`` names a column of unique longs to return as __row_id; no other column is taken for one.
    """
    rows = materialise(fingerprints(docs, shingle, seed, id_col, text_col, row_col), "fingerprints")
    fps = materialise(rows.groupBy("fp").agg(F.min("id").alias("id"), F.min(F.when(F.col("id").isNull(), F.col(ROW_ID))).alias("bare")),
                      "distinct-fingerprints")
    roots = connected_components(links(fps, max_bits))
    member = materialise(fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                         .select("fp", F.coalesce("root", "fp").alias("root"), "id", "bare"), "members")
    heads = materialise(member.groupBy("root").agg(F.min("id").alias("component"), F.min("bare").alias("bare")), "heads")
    component = materialise(member.select("fp", "root").join(heads, "root").select("fp", "component", "bare"), "fp-components")
    out = rows.join(component, "fp")
    # of rows that repeat the smallest id the first one stays; without any id, the first row
    first = materialise(out.where(F.col("id").eqNullSafe(F.col("component"))).groupBy("component", F.when(F.col("component").isNull(), F.col("bare")).alias("b"))
                        .agg(F.min(ROW_ID).alias(ROW_ID)).select(ROW_ID, F.lit(True).alias("keep")), "heads-rows")
    return (out.join(first, ROW_ID, "left")
            .select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.col("component").alias("component_id"), F.col(ROW_ID), F.coalesce("keep", F.lit(False)).alias("keep")))
