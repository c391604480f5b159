"""Ordering-dependent selections: few-shot support, per-label positions, first N,
stratified split, split counts (W02, W03, A08, A09, O03).

Spark tables have no row order, so every operator takes an explicit ordinal
column (``example_id``). Positions inside a label use ``group_ordinal``, which
stays balanced when one label holds a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelflow.functions.text import py_strip


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# Rows of a group that one task orders at most, and buckets of all groups together; the first
# grows with the table so that the second bounds what is broadcast.
BUCKET_ROWS = 500_000
MAX_BUCKETS = 20_000


def group_ordinal(df: DataFrame, group, order, out: str = "position", total: str | None = None,
                  bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """0-based position of each row inside its group, by ``order`` (exact, skew-safe).

    A plain ``row_number()`` window sorts each group in one task, so a label
    holding a third of the rows becomes a third of the job in one task. Here a
    group of many rows is cut into buckets of about ``bucket_rows``: two passes
    over the group and order columns alone sample bounds by hash and count the
    rows of each bucket; the rows themselves are shuffled once, to
    ``row_number()`` inside (group, bucket), and the rows of earlier buckets are
    added. Bounds and counts, at most about MAX_BUCKETS rows whatever the table,
    are computed when the plan is built and enter it as small broadcast tables.
    ``order`` should make rows unique within a group for a deterministic result.
    ``total`` names a further column with the rows of the group.
    """
    group, order = _list(group), _list(order)
    narrow = df.select(*group, *order)
    size = max(bucket_rows, -(-narrow.count() // MAX_BUCKETS))
    place = F.struct(*order)
    hit = F.pmod(F.xxhash64(F.lit(11), *group, *order), F.lit(size)) == 0
    bounds = (narrow.where(hit).groupBy(*group).agg(F.array_sort(F.collect_set(place)).alias("_bounds"))
              .select(*[F.col(g).alias(f"_g_{g}") for g in group], "_bounds"))

    def local(rows: list, schema) -> DataFrame:
        return F.broadcast(df.sparkSession.createDataFrame(rows, schema))

    found = bounds.collect()
    if not found:  # one bucket for each group
        whole = Window.partitionBy(*group)
        extra = [] if total is None else [F.count(F.lit(1)).over(whole).alias(total)]
        position = (F.row_number().over(whole.orderBy(*order)) - 1).cast("bigint")
        return df.select("*", position.alias(out), *extra)
    most = max(len(r["_bounds"]) for r in found)
    bounds = local(found, bounds.schema)

    def bucketed(rows: DataFrame) -> DataFrame:
        same = [rows[g].eqNullSafe(F.col(f"_g_{g}")) for g in group]
        rows = rows.join(bounds, same, "left").withColumn("__place", place).withColumn("_bucket", F.lit(0))
        # the bounds up to the place are counted by halving, in plain columns: lambda functions leave
        # compiled code, and all bounds of a group would be copied to each of its rows
        for step in (1 << k for k in reversed(range(most.bit_length()))):
            after = F.col("_bucket") + step
            rows = rows.withColumn("_bucket", F.when(F.get("_bounds", after - 1) <= F.col("__place"), after).otherwise(F.col("_bucket")))
        return rows

    counts = (bucketed(narrow).where(F.col("_bounds").isNotNull()).groupBy(*[F.col(g).alias(f"_h_{g}") for g in group], F.col("_bucket").alias("_b"))
              .agg(F.count(F.lit(1)).alias("_n")))
    whole = Window.partitionBy(*[f"_h_{g}" for g in group])  # the buckets of a group, not its rows
    offsets = counts.select(*[f"_h_{g}" for g in group], "_b",
                            F.coalesce(F.sum("_n").over(whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                            F.sum("_n").over(whole).alias("_rows"))
    inside = Window.partitionBy(*group, "_bucket")
    rows = bucketed(df)
    same = [rows[g].eqNullSafe(F.col(f"_h_{g}")) for g in group] + [F.col("_bucket") == F.col("_b")]
    numbered = (rows.join(local(offsets.collect(), offsets.schema), same, "left")
                .withColumn(out, F.row_number().over(inside.orderBy(*order)) - 1 + F.coalesce("_before", F.lit(0)).cast("bigint")))
    extra = [] if total is None else [F.coalesce("_rows", F.count(F.lit(1)).over(inside)).alias(total)]
    return numbered.select(*[F.col(c) for c in df.columns], F.col(out), *extra)


def few_shot_support(df: DataFrame, label: str = "label", order: str = "example_id", n: int = 4,
                     cols: Sequence[str] = ("utterance",)) -> DataFrame:
    """Round-robin support set: labels sorted, the k-th example of each label in order, at most n.

    ``row_number() <= n`` lets Spark insert a partial WindowGroupLimit before the
    shuffle, so at most n rows per label and task are exchanged; the final
    top-n is a TakeOrderedAndProject over at most n rows per label.
    """
    lab = py_strip(F.col(label))
    w = Window.partitionBy("label").orderBy(order)
    ranked = (df.select(order, *cols, lab.alias("label")).where(F.length("label") > 0)
              .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n))
    return (ranked.orderBy("_rn", "label").limit(n)
            .select(order, "label", *cols, (F.col("_rn") - 1).alias("round")))


def collect_support(support: DataFrame, utterance: str = "utterance", label: str = "label",
                    n: int = 4) -> list[tuple[str, str]]:
    """The (utterance, label) pairs of a support set, in round-robin order (at most n rows)."""
    rows = support.orderBy("round", label).limit(n).collect()
    return [(r[utterance], r[label]) for r in rows]


def examples_by_label(df: DataFrame, label: str = "label", order: str = "example_id",
                      cols: Sequence[str] = ("utterance",)) -> DataFrame:
    """Examples grouped by label in file order, blank labels dropped.

    Long form ``(label, position, order, cols...)`` instead of one list per
    label: a label's list would be one unbounded row.
    """
    base = (df.select(order, *cols, py_strip(F.col(label)).alias("label"))
            .where(F.length("label") > 0))
    return group_ordinal(base, "label", order)


def first_n_rows(df: DataFrame, n: int, order: str = "example_id") -> DataFrame:
    """The first n rows in ordinal order (O03): a top-n, not a full sort."""
    return df.orderBy(order).limit(n)


def split_counts(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Rows and distinct labels per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.count_distinct(F.col(label)).alias("n_labels"))


def apportion(counts: DataFrame, share: float, label: str = "label", n: str = "n", total: str = "round") -> DataFrame:
    """Largest-remainder quotas: ``quota`` of each label, together exactly round(share * N) or, as
    scikit-learn counts, ceil(share * N).

    Every label gets the whole part of its share; what is missing goes to the largest remainders,
    ties to the larger label, then alphabetically. Shares are compared as exact decimals.
    """
    if total not in ("round", "ceil"):
        raise ValueError("total must be 'round' or 'ceil'")
    if not 0 <= share <= 1:
        raise ValueError("share must be between 0 and 1")
    exact = F.lit(repr(float(share))).cast("decimal(18,17)" if share < 1 else "decimal(18,0)")
    part = F.col(n).cast("decimal(20,0)") * exact
    parts = counts.select(F.col(label), F.col(n), F.floor(part).cast("bigint").alias("_whole"), (part - F.floor(part)).cast("decimal(18,17)").alias("_rest"))
    rows, whole = parts.agg(F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.sum("_whole"), F.lit(0))).first()
    from decimal import ROUND_CEILING, ROUND_HALF_UP, Decimal

    wanted = int((Decimal(rows) * Decimal(repr(float(share)))).to_integral_value(ROUND_HALF_UP if total == "round" else ROUND_CEILING))
    # the labels in order of remainder, without a sort in one task
    order = parts.select("*", (-F.col("_rest")).alias("_least"), (-F.col(n)).alias("_most"), (F.col(n) < 0).alias("_all"))
    placed = group_ordinal(order, "_all", ["_least", "_most", label], out="_place")
    return placed.select(label, n, (F.col("_whole") + (F.col("_place") < wanted - whole).cast("bigint")).alias("quota"))


def stratified_split(df: DataFrame, label: str = "label", key: str = "example_id", test_size: float = 0.1,
                     seed: int = 42, bucket_rows: int = BUCKET_ROWS, quota: str = "label") -> DataFrame:
    """Per-label split: the rows of each label with the smallest md5(seed|key) go to validation.

    ``quota="label"`` takes round(test_size * n) rows of each label on its own; ``"round"`` and
    ``"ceil"`` share out that part of all rows by largest remainders (``apportion``), so that the validation
    set has exactly the size asked for and labels of a few rows aren't all left out.

    Deterministic and identical across engines; not bit-equal to scikit-learn's
    shuffle. Positions and per-label totals both come from ``group_ordinal``, so
    a dominant label does not serialise the job and the rows are shuffled once.
    Rows without a label are kept with a NULL ``assigned``.
    """
    h = F.md5(F.concat(F.lit(str(seed)), F.lit("|"), F.col(key).cast("string")))
    pos = group_ordinal(df.withColumn("_h", h), label, ["_h", key], out="_pos", total="_n", bucket_rows=bucket_rows)
    if quota == "label":
        most = F.round(F.lit(test_size) * F.col("_n"))
    else:
        from labelflow.operators.vocab import lookup

        counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_rows"))
        quotas = apportion(counts, test_size, label, "_rows", quota).select(label, F.col("quota").alias("_quota"))
        pos, most = lookup(pos, quotas, label), F.col("_quota")
    return pos.select(*df.columns, F.when(F.col(label).isNull(), F.lit(None).cast("string"))
                      .when(F.col("_pos") < most, F.lit("validation")).otherwise(F.lit("train")).alias("assigned"))
