"""Near-duplicate embeddings by NN-descent.

Equal vectors of a label are one node. Lists of ``k`` neighbours start from random-projection
orders: in each tree, nodes are sorted by the signs and value of random projections and compared
with the next few. Rounds of NN-descent follow: at every node, the nodes that list it or that it
lists are compared with each other (neighbours of neighbours) and better neighbours enter lists.
Pairs at the threshold or above are verified in double precision and kept.

A list is saturated if all its entries reach the threshold: more neighbours may be waiting, also
in other components. Components with a saturated node are compared with each other within their
label and merged where any pair links. The list of each of their nodes is then enlarged to the
whole component, whose links are counted block by block, so that no block holds more than its
share of a group.
An audit compares ``audit`` nodes, chosen by hash, with all rows and measures the share of true
links found; below ``recall`` the descent goes on with twice the list length and trees, and the
call raises if that doesn't help either.

Vectors are compared if their labels are equal and not null and their lengths agree. Null and
empty vectors, zero vectors and those with null or non-finite components link with nothing; they
are rows with no links of their own. Repeated rows are copies of each other. A component without
any id has a null component_id. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelflow.llm.common import ROW_ID, materialise, with_row_id
from labelflow.llm.components import connected_components

WINDOW = 6
PER_TREE = 3
BLOCK = 512
_TOLERANCE = 1e-4  # of single precision, within which candidates are verified in double


def _arrays(column: pa.Array, dim: int, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, dim)


def _usable(rows: DataFrame) -> DataFrame:
    """(row id, id, label, dim, unit vector as doubles) of the rows that can link."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull()).where((F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0))

    def run(batches):
        for batch in batches:
            unit = []
            for x in batch.column(2).to_pylist():
                a = np.asarray(x, dtype="<f8") + 0.0
                a = a / np.abs(a).max()
                unit.append((a / np.sqrt(a @ a)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(u) // 8 for u in unit], pa.int32()),
                                              pa.array(unit, pa.binary())], [ROW_ID, "label", "dim", "vec"])

    return some.select(ROW_ID, "label", "vec").mapInArrow(run, f"{ROW_ID} bigint, label string, dim int, vec binary")


def _seed_edges(nodes: DataFrame, trees: int, bits: int, salt: int) -> DataFrame:
    """(a, b, sim) from neighbours in random-projection orders, both ways."""
    def spread(batches):
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                x = _arrays(some.column(3), dim, "<f4")
                for t in range(trees):
                    rng = np.random.default_rng([salt, t, dim])
                    p = x @ rng.standard_normal((dim, bits + 1)).astype(np.float32)
                    code = ((p[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))).astype(np.int64) if bits else np.zeros(len(x), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t), pa.int32()), some.column(1), some.column(2), pa.array(code), pa.array(p[:, bits].astype(float)),
                         some.column(0), some.column(3)], ["tree", "label", "dim", "code", "value", "node", "vec"])

    order = ["tree", "label", "dim", "code", "value", "node"]
    laid = (nodes.select("node", "label", "dim", "vec32").mapInArrow(spread, "tree int, label string, dim int, code bigint, value double, node bigint, vec binary")
            .repartitionByRange(*order).sortWithinPartitions(*order))

    def compare(batches):
        last: list[pa.RecordBatch] = []
        for batch in batches:
            joined = pa.Table.from_batches([*last, batch]).combine_chunks().to_batches()[0] if last else batch
            done = last[0].num_rows if last else 0
            group = [f"{t}|{d}|{lab}" for t, lab, d in zip(joined.column(0).to_pylist(), joined.column(1).to_pylist(), joined.column(2).to_pylist(), strict=True)]
            node, raw = joined.column(5).to_numpy(), joined.column(6).to_pylist()
            sims: dict[int, list[tuple[float, int]]] = {}
            at = 0
            while at < len(group):  # runs of one tree, label and length
                end = at
                while end < len(group) and group[end] == group[at]:
                    end += 1
                x = np.frombuffer(b"".join(raw[at:end]), dtype="<f4").reshape(end - at, -1)
                for step in range(1, min(WINDOW, end - at - 1) + 1):
                    for i, s in enumerate(np.einsum("ij,ij->i", x[:-step], x[step:]).tolist()):
                        if at + i + step >= done:  # not already compared with the last batch
                            sims.setdefault(at + i, []).append((s, at + i + step))
                            sims.setdefault(at + i + step, []).append((s, at + i))
                at = end
            out = [(int(node[i]), int(node[j]), s) for i, best in sims.items() for s, j in sorted(best, reverse=True)[:PER_TREE]]
            yield _edge_batch(out)
            last = [joined.slice(max(0, joined.num_rows - WINDOW))]

    return laid.mapInArrow(compare, "a bigint, b bigint, sim double")


def _edge_batch(edges: list) -> pa.RecordBatch:
    a, b, s = zip(*edges, strict=True) if edges else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())], ["a", "b", "sim"])


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The k best neighbours of each node."""
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return edges.groupBy("a", "b").agg(F.max("sim").alias("sim")).withColumn("r", rank).where(F.col("r") <= k).drop("r")


def _descend(lists: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """One round: nodes around each node are compared with each other; improvements enter the lists."""
    around = _best(lists.select("a", "b", "sim").union(lists.select("b", "a", "sim")), 2 * k)
    worst = lists.groupBy("a").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(F.lit(-2.0)).alias("worst"))
    carried = (around.select(F.col("b").alias("a"), F.col("a").alias("v")).join(worst, "a")
               .join(nodes.select(F.col("node").alias("a"), "vec32"), "a").select("v", "a", "worst", "vec32"))

    def local(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0] if rest is not None and rest.num_rows else batch
            v = table.column(0).to_numpy()
            cut = int(np.searchsorted(v, v[-1])) if len(v) else 0  # the last node's rows may go on in the next batch
            yield _edge_batch(_compare_around(table.slice(0, cut)))
            rest = table.slice(cut)
        if rest is not None:
            yield _edge_batch(_compare_around(rest))

    found = carried.repartition("v").sortWithinPartitions("v").mapInArrow(local, "a bigint, b bigint, sim double")
    return _best(lists.union(found).union(found.select("b", "a", "sim")), k)


def _compare_around(rows: pa.RecordBatch) -> list:
    if not rows.num_rows:
        return []
    v, a, worst, raw = rows.column(0).to_numpy(), rows.column(1).to_numpy(), rows.column(2).to_numpy(), rows.column(3).to_pylist()
    starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    out = []
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(v)], strict=True):
        if e - s < 2:
            continue
        x = np.frombuffer(b"".join(raw[s:e]), dtype="<f4").reshape(e - s, -1)
        sims = x @ x.T
        i, j = np.nonzero(np.triu((sims > worst[s:e, None]) | (sims > worst[None, s:e]), 1))
        out += zip(a[s:e][i].tolist(), a[s:e][j].tolist(), sims[i, j].astype(float).tolist(), strict=True)
    return out


def _verified(lists: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(u, v), u < v: listed pairs at the threshold or above in double precision."""
    pairs = lists.where(F.col("sim") >= threshold - _TOLERANCE).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
    both = (pairs.join(nodes.select(F.col("node").alias("u"), F.col("vec").alias("x")), "u")
            .join(nodes.select(F.col("node").alias("v"), F.col("vec").alias("y")), "v").select("u", "v", "x", "y"))

    def run(batches):
        for batch in batches:
            ok = [float(np.frombuffer(x, "<f8") @ np.frombuffer(y, "<f8")) >= threshold
                  for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(run, "u bigint, v bigint")


def _count_in_blocks(members: DataFrame, threshold: float) -> DataFrame:
    """(node, n): summed copies of the nodes linked with each node of ``members`` (root, node, vec, copies), by pairs of blocks."""
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, "root").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    paired = (dealt.select("root", "node", "vec", "copies", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"))
              .select("root", F.least("mine", "x").alias("i"), F.greatest("mine", "x").alias("j"), "mine", "node", "vec", "copies"))

    def count(pdf):
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        left = pdf[pdf["mine"] == i].drop_duplicates("node")
        right = pdf[pdf["mine"] == j].drop_duplicates("node")
        if not len(left) or not len(right):
            return pdf.iloc[:0][["node"]].assign(n=0)
        x = np.frombuffer(b"".join(left["vec"]), "<f8").reshape(len(left), -1)
        y = np.frombuffer(b"".join(right["vec"]), "<f8").reshape(len(right), -1)
        linked = (x @ y.T) >= threshold
        linked &= left["node"].to_numpy()[:, None] != right["node"].to_numpy()[None, :]
        out = left[["node"]].assign(n=linked @ right["copies"].to_numpy())
        if i != j:
            import pandas as pd

            out = pd.concat([out, right[["node"]].assign(n=left["copies"].to_numpy() @ linked)])
        return out

    return paired.groupBy("root", "i", "j").applyInPandas(count, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("n"))


def _roots_in(pairs: np.ndarray, n: int) -> list[int]:
    """The smallest position reachable from each of ``n`` positions over ``pairs``."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs.tolist():
        i, j = find(i), find(j)
        root[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


def _merged(members: DataFrame, threshold: float) -> DataFrame:
    """(u, v): roots of components of ``members`` (root, node, label, dim, vec) that some pair at the threshold links.

    Components are cut into pieces of about BLOCK members, each known by one member and the widest
    angle to it. Pieces of a label are compared by blocks of these members: at the threshold they
    link; where the angles leave it open, all members of both pieces are compared.
    """
    import pandas as pd

    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    laid = materialise(members.join(sizes, "root").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
                       .select("root", "mine", "node", "label", "dim", "vec"), "saturated-pieces")

    def span(pdf):
        x = np.frombuffer(b"".join(pdf["vec"]), "<f8").reshape(len(pdf), -1)
        head = int(pdf["node"].to_numpy().argmin())
        wide = float(np.arccos(np.clip(x @ x[head], -1.0, 1.0)).max())
        return pdf.iloc[[head]][["root", "mine", "label", "dim", "vec"]].assign(wide=wide)

    heads = materialise(laid.groupBy("root", "mine").applyInPandas(span, "root bigint, mine int, label string, dim int, vec binary, wide double"), "piece-heads")
    per_label = heads.groupBy("label", "dim").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.countDistinct("root").alias("n")).where("n > 1").drop("n")
    dealt = heads.join(per_label, ["label", "dim"]).withColumn("at", F.pmod(F.xxhash64("root", "mine"), F.col("blocks")).cast("int"))
    paired = (dealt.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("label", "dim", F.least("at", "x").alias("i"), F.greatest("at", "x").alias("j"), "at", "root", "mine", "vec", "wide"))

    def compare(pdf):
        pdf = pdf.drop_duplicates(["root", "mine"]).reset_index(drop=True)
        root, mine, wide = pdf["root"].to_numpy(), pdf["mine"].to_numpy(), pdf["wide"].to_numpy()
        x = np.frombuffer(b"".join(pdf["vec"]), "<f8").reshape(len(pdf), -1)
        sims = np.clip(x @ x.T, -1.0, 1.0)
        apart = np.triu(root[:, None] != root[None, :], 1)
        sure = np.argwhere(apart & (sims >= threshold))
        group = np.array(_roots_in(np.concatenate([sure, _same(root)]), len(pdf)))
        first = np.flatnonzero(group != np.arange(len(pdf)))
        links = pd.DataFrame({"u": root[first], "v": root[group[first]], "p": 0, "q": 0, "sure": True})
        links = links[links["u"] != links["v"]]
        room = np.arccos(sims) <= np.arccos(threshold) + wide[:, None] + wide[None, :] + _TOLERANCE
        i, j = np.nonzero(apart & room & (group[:, None] != group[None, :]))
        maybe = pd.DataFrame({"u": root[i], "v": root[j], "p": mine[i], "q": mine[j], "sure": False})
        return pd.concat([links, maybe], ignore_index=True)

    found = materialise(paired.groupBy("label", "dim", "i", "j").applyInPandas(compare, "u bigint, v bigint, p int, q int, sure boolean"), "piece-pairs")
    sure = found.where("sure").select("u", "v")
    now = connected_components(sure)
    at_u, at_v = now.toDF("u", "x"), now.toDF("v", "y")
    open_ = (found.where("not sure").distinct().join(at_u, "u", "left").join(at_v, "v", "left")
             .where(F.coalesce("x", "u") != F.coalesce("y", "v")).select("u", "p", "v", "q"))
    ends = materialise(open_.withColumn("pair", F.monotonically_increasing_id()), "open-pairs")
    both = (ends.select("pair", F.col("u").alias("root"), F.col("p").alias("mine")).union(ends.select("pair", "v", "q"))
            .join(laid.select("root", "mine", "vec"), ["root", "mine"]))

    def decide(pdf):
        x, y = (np.frombuffer(b"".join(g["vec"]), "<f8").reshape(len(g), -1) for _, g in pdf.groupby("root"))
        u, v = sorted(set(pdf["root"].tolist()))
        return pd.DataFrame({"u": [u], "v": [v]}).iloc[: int(((x @ y.T) >= threshold).any())]

    return sure.union(both.groupBy("pair").applyInPandas(decide, "u bigint, v bigint")).distinct()


def _same(root: np.ndarray) -> np.ndarray:
    """Pairs of positions that chain equal values of ``root``."""
    order = np.argsort(root, kind="stable")
    equal = root[order][1:] == root[order][:-1]
    return np.stack([order[:-1][equal], order[1:][equal]], axis=1)


def _audit(nodes: DataFrame, counts: DataFrame, threshold: float, audit: int) -> float:
    """Share of the true links of about ``audit`` nodes that ``counts`` (node, n) has; compares them with all rows."""
    total = nodes.count()
    part = F.pmod(F.xxhash64(F.col("node"), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    asked = nodes.where(part * total < audit).select("node", "label", "dim", "vec").collect()
    shared = nodes.sparkSession.sparkContext.broadcast([(r[0], r[1], r[2], bytes(r[3])) for r in asked])

    def run(batches):
        by: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
        for label, dim in {(q[1], q[2]) for q in shared.value}:
            some = [q for q in shared.value if q[1:3] == (label, dim)]
            by[label, dim] = np.array([q[0] for q in some]), np.frombuffer(b"".join(q[3] for q in some), "<f8").reshape(len(some), dim)
        sums: dict[int, int] = {}
        for batch in batches:
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            for key in set(keys) & set(by):
                rows = batch.filter(pa.array([k == key for k in keys]))
                ids, q = by[key]
                linked = (q @ _arrays(rows.column(3), key[1], "<f8").T) >= threshold
                linked &= ids[:, None] != rows.column(0).to_numpy()[None, :]
                for node, n in zip(ids.tolist(), (linked @ rows.column(4).to_numpy()).tolist(), strict=True):
                    sums[node] = sums.get(node, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], ["node", "true"])

    true = nodes.select("node", "label", "dim", "vec", "copies").mapInArrow(run, "node bigint, true bigint").groupBy("node").agg(F.sum("true").alias("true"))
    row = true.join(counts, "node", "left").agg(F.sum("true"), F.sum(F.least("true", F.coalesce("n", F.lit(0))))).first()
    return 1.0 if not row[0] else row[1] / row[0]


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    k: int = 8, trees: int = 8, rounds: int = 3, audit: int = 512, recall: float = 0.95, attempts: int = 3) -> DataFrame:
    """Per row: id_col, n_links, component_id (smallest id reachable), kept."""
    rows = materialise(with_row_id(vectors.select(vectors[id_col].alias("id"), vectors[label_col].cast("string").alias("label"),
                                                  vectors[vec_col].cast("array<double>").alias("vec"))), "vectors")
    units = materialise(_usable(rows).withColumn("key", F.sha2("vec", 256)), "unit-vectors")
    grouped = units.groupBy("label", "dim", "key").agg(F.min(ROW_ID).alias("node"), F.count("*").alias("copies"))
    grouped = materialise(grouped, "vector-groups")

    def halve(batches):
        for batch in batches:
            single = [np.frombuffer(x, "<f8").astype("<f4").tobytes() for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(single, pa.binary())], [*batch.schema.names, "vec32"])

    nodes = materialise(units.select(F.col(ROW_ID).alias("node"), "vec").join(grouped, "node").select("node", "label", "dim", "vec", "copies")
                        .mapInArrow(halve, "node bigint, label string, dim int, vec binary, copies bigint, vec32 binary"), "vector-nodes")
    member = materialise(units.select(ROW_ID, "label", "dim", "key").join(grouped, ["label", "dim", "key"]).select(ROW_ID, "node", "copies"), "vector-members")
    largest = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits = max(0, min(24, int(np.ceil(np.log2(max(1, largest / 32))))))

    lists, reached = None, 0.0
    for attempt in range(attempts):
        seeds = _seed_edges(nodes, trees, bits, attempt)
        lists = materialise(_best(seeds if lists is None else lists.union(seeds), k), "neighbours")
        for _ in range(rounds):
            lists = materialise(_descend(lists, nodes, k), "neighbours")
        edges = materialise(_verified(lists, nodes, threshold), "vector-links")
        roots = materialise(connected_components(edges), "vector-roots")
        full = lists.groupBy("a").agg(F.count("*").alias("c"), F.min("sim").alias("least")).where(
            (F.col("c") >= k) & (F.col("least") >= threshold - _TOLERANCE)).select(F.col("a").alias("node"))
        crowded = materialise(roots.join(full, "node", "left_semi").select("root").distinct(), "saturated-components")
        inside = materialise(roots.join(crowded, "root", "left_semi"), "saturated-members")
        over = connected_components(_merged(inside.join(nodes, "node").select("root", "node", "label", "dim", "vec"), threshold))
        over = over.select(F.col("node").alias("root"), F.col("root").alias("top"))
        roots, inside = (materialise(r.join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root")), name)
                         for r, name in ((roots, "merged-roots"), (inside, "merged-members")))
        dense = _count_in_blocks(inside.join(nodes, "node").select("root", "node", "vec", "copies"), threshold)
        ends = edges.select(F.col("u").alias("node"), F.col("v").alias("other")).union(edges.select("v", "u"))
        sparse = (ends.join(inside.select("node"), "node", "left_anti")
                  .join(nodes.select(F.col("node").alias("other"), "copies"), "other").groupBy("node").agg(F.sum("copies").alias("n")))
        counts = materialise(dense.unionByName(sparse), "link-counts")
        reached = _audit(nodes, counts, threshold, audit)
        if reached >= recall:
            break
        k, trees = 2 * k, 2 * trees
    if reached < recall:
        raise RuntimeError(f"recall {reached:.3f} is below {recall} after {attempts} attempts")

    linked = (member.join(counts, "node", "left").join(roots, "node", "left")
              .select(ROW_ID, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")))
    full_rows = materialise(rows.select(ROW_ID, "id").join(linked, ROW_ID, "left")
                            .select(ROW_ID, "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                    F.coalesce("root", F.col(ROW_ID)).alias("root")), "linked-rows")
    heads = materialise(full_rows.groupBy("root").agg(F.min("id").alias("component_id")), "vector-heads")
    return full_rows.join(heads, "root").select(F.col("id").alias(id_col), "n_links", "component_id",
                                                F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
