"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join that treats NULL keys as equal, as GROUP BY and PARTITION BY do.

    No broadcast hint: the adaptive planner broadcasts ``right`` when its measured
    size allows it and otherwise splits skewed partitions of a sort-merge join.
    """
    if not keys:
        return with_one_row(left, right)
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"__r_{k}" for k in keys])


def with_one_row(left: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row, as a scalar subquery (fails on a second row)."""
    if not one_row.columns:
        return left
    row = one_row.select(F.struct("*")).scalar()
    added = left.withColumn("__one_row", row)
    return added.select(*left.columns, *[F.col("__one_row").getField(c).alias(c) for c in one_row.columns])
