"""Sharding along a Hilbert curve: rows close in several metadata dimensions land in the same shard files.

DataFrame functions only. Each dimension is quantised to equally filled steps, the steps give a curve index, rows are
range-partitioned by that index, and the global order is cut into runs. No window spans more than one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

LOCAL_BITS = 33  # monotonically_increasing_id keeps the place inside a partition in its low 33 bits


def running_total(df: DataFrame, order: Sequence[str], amount: str, label: str) -> DataFrame:
    """``df`` stored in global order with ``__before``, the sum of ``amount`` over all earlier rows.

    Ranges are sorted and summed on their own; only one total per range meets in a single task. ``order`` should
    make rows distinct, or rows that tie should be interchangeable.
    """
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("__place", F.monotonically_increasing_id()))
    stored = materialize(placed, label).withColumn("__range", F.shiftright("__place", LOCAL_BITS))
    totals = stored.groupBy("__range").agg(F.sum(amount).alias("__total"))
    across = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__range", F.coalesce(F.sum("__total").over(across), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__range").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    local = stored.withColumn("__local", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    joined = local.join(offsets, "__range")
    return (joined.withColumn("__before", F.col("__offset") + F.col("__local"))
            .drop("__range", "__place", "__offset", "__local"))


def quantise(df: DataFrame, column: str, bits: int, total: int) -> DataFrame:
    """Values of ``column`` (null first) with ``__step``: the share of rows with a smaller value, in 2^bits steps.

    Order of steps is order of values, steps hold about equally many rows, and equal values share a step.
    """
    values = df.groupBy(F.col(column).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    before = running_total(values, ["__value"], "__n", "steps")
    step = F.floor(F.col("__before") * (2 ** bits) / F.lit(max(1, total))).cast("int")
    return before.select("__value", step.alias("__step"))


def hilbert_index(df: DataFrame, axes: Sequence[str], bits: int, out: str) -> DataFrame:
    """Add the Hilbert curve index of integer axes of ``bits`` bits; the axes columns are consumed.

    Published transform from axes to transposed index: undo excess work from the top bit down, then Gray-encode.
    """
    first, last = axes[0], axes[-1]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for axis in axes:
            here = F.col(axis).bitwiseAND(bit) != 0
            swap = F.col(first).bitwiseXOR(F.col(axis)).bitwiseAND(low)
            if axis == first:
                df = df.withColumn(first, F.when(here, F.col(first).bitwiseXOR(F.lit(low))).otherwise(F.col(first)))
            else:
                df = df.withColumns({
                    first: F.when(here, F.col(first).bitwiseXOR(F.lit(low)))
                            .otherwise(F.col(first).bitwiseXOR(swap)),
                    axis: F.when(here, F.col(axis)).otherwise(F.col(axis).bitwiseXOR(swap))})
    for before, axis in zip(axes, axes[1:]):
        df = df.withColumn(axis, F.col(axis).bitwiseXOR(F.col(before)))
    flip = F.lit(0)
    for level in range(bits - 1, 0, -1):
        flip = flip.bitwiseXOR(F.when(F.col(last).bitwiseAND(1 << level) != 0, F.lit((1 << level) - 1))
                               .otherwise(F.lit(0)))
    df = df.withColumn("__flip", flip)
    index = F.lit(0).cast("bigint")
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            value = F.col(axis).bitwiseXOR(F.col("__flip"))
            index = index * 2 + F.shiftright(value, level).bitwiseAND(1)
    return df.withColumn(out, index).drop("__flip", *axes)


def hilbert_shards(docs: DataFrame, dims: Sequence[str], shards: int, ties: Sequence[str] = (), bits: int = 5
                   ) -> DataFrame:
    """``docs`` with ``curve`` (Hilbert index), ``shard`` (0 to shards-1) and ``slot`` (gapless in the shard).

    Row counts of shards differ by at most one (law ``rows``). Rows are ordered by curve index, then by ``ties``;
    rows equal in all of these are interchangeable. Null is the smallest value of a dimension; rows that repeat each
    get a slot of their own; with fewer rows than shards some shards stay empty; an empty table gives an empty
    table. Input columns called ``curve``, ``shard`` or ``slot`` are replaced, all others pass through.
    """
    replaced = ("curve", "shard", "slot")
    clash = {c: f"__in_{c}" for c in replaced if c in docs.columns and c in [*dims, *ties]}
    for old, new in clash.items():
        docs = docs.withColumnRenamed(old, new)
    dims, ties = [clash.get(c, c) for c in dims], [clash.get(c, c) for c in ties]
    docs = docs.drop(*[c for c in replaced if c in docs.columns])
    total = docs.count()
    axes = []
    placed = docs
    for i, dim in enumerate(dims):
        axis = f"__axis{i}"
        steps = quantise(docs, dim, bits, total).toDF("__value", axis)
        placed = placed.join(steps, F.col(dim).eqNullSafe(F.col("__value"))).drop("__value")
        axes.append(axis)
    indexed = hilbert_index(placed, axes, bits, "curve").withColumn("__one", F.lit(1))
    ordered = running_total(indexed, ["curve", *ties], "__one", "shards")
    out = ordered.withColumn("shard", F.expr(f"cast((__before * {shards}L) div {max(1, total)}L as int)"))
    start = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return out.withColumn("slot", F.col("__before") - start).drop("__one", "__before", *clash.values())


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
