"""Exact ranks, quantiles and neighbours inside groups of any size, by one plan.

Rows collapse to distinct values with counts, all measures in one partial aggregation. The values are range-partitioned
in the order (measure, group, value), so a huge group is spread over as many tasks as its values ask for, and a hot value
is one row. The partition number is stored with the rows, which pins the cut. Places are summed inside the ranges and the
totals of earlier ranges are added.

Ranks travel back in long form. Rows with equal groups and measures are one profile, counted once and numbered. The cells
of the profiles (number, measure, group, value) meet the ranked values in one join per data type, one regroup by number
makes a narrow row of them, and the wide rows join that row by group and measures: they are shuffled once, however many
measures there are, and only narrow tables are stored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .joins import join_same

LOCAL_BITS = 33  # monotonically_increasing_id keeps the place inside a partition in its low 33 bits


def in_ranges(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``df`` stored in global order, with ``__range``, the number of its range, and ``__place`` in that order."""
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("__place", F.monotonically_increasing_id()))
    return materialize(placed, label).withColumn("__range", F.shiftright("__place", LOCAL_BITS))


def _by_type(df: DataFrame, measures: Sequence[str]) -> list[list[str]]:
    """Measures that share a data type can share a column."""
    kinds: dict[str, list[str]] = {}
    for m in measures:
        kinds.setdefault(df.schema[m].dataType.simpleString(), []).append(m)
    return list(kinds.values())


def _cells(df: DataFrame, keep: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A row per row and measure: ``__m`` (number of the measure), the ``keep`` columns, ``__v``."""
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("__m"), F.col(m).alias("__v")) for i, m in enumerate(measures)]))
    return df.select(*keep, cells.alias("__c")).select("__c.__m", *keep, "__c.__v")


def value_ranks(df: DataFrame, keys: Sequence[str], measures: Sequence[str], weight: str | None = None) -> DataFrame:
    """Distinct values (NULL too) of measures of one type, per group.

    Columns: ``__m`` (number of the measure), the keys, ``__v``, ``__ties`` (rows with the value), ``__below`` (rows
    with a smaller known value; all known rows for NULL), ``__valid`` (known rows of the group), ``__all`` (its rows).
    A row counts as many as the column ``weight`` says.
    """
    kept = [*keys, weight] if weight else keys
    values = _cells(df, kept, measures).groupBy("__m", *keys, "__v").agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("__ties"))
    stored = in_ranges(values, ["__m", *keys, "__v"], "values")
    # As a struct the keys compare with NULL equal to NULL, so windows and the join share one exchange.
    stored = stored.withColumn("__group", F.struct("__m", *keys))
    known = F.when(F.col("__v").isNotNull(), F.col("__ties")).otherwise(0)
    parts = stored.groupBy("__range", "__group").agg(F.sum(known).alias("__known"), F.sum("__ties").alias("__rows"))
    across = Window.partitionBy("__group")
    earlier = across.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__range", "__group", F.coalesce(F.sum("__known").over(earlier), F.lit(0)).alias("__offset"),
                         F.sum("__known").over(across).alias("__valid"), F.sum("__rows").over(across).alias("__all"))
    inside = Window.partitionBy("__range", "__group").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    local = stored.withColumn("__local", F.coalesce(F.sum(known).over(inside), F.lit(0)))
    below = F.when(F.col("__v").isNull(), F.col("__valid")).otherwise(F.col("__offset") + F.col("__local"))
    joined = local.join(parts, ["__range", "__group"])
    return joined.select("__m", *keys, "__v", "__ties", below.alias("__below"), "__valid", "__all")


def with_shares(df: DataFrame, keys: Sequence[str], outputs: Mapping[str, str], share: Callable[[Column], Column],
                descending: Sequence[str] = (), unknown: bool = True) -> DataFrame:
    """Add a number per row and measure that depends on the value's rank in its group; ``outputs`` maps new name to measure.

    ``share`` gets the rows below the value (NULL sorts last; above it for ``descending`` measures) and may use ``__v``,
    ``__ties``, ``__valid`` and ``__all``. Cells that are NULL get NULL without being looked up unless ``unknown``.
    ``df`` is read twice.
    """
    measures = list(dict.fromkeys(outputs.values()))
    profiles = materialize(df.groupBy(*keys, *[m for m in measures if m not in keys]).agg(F.count(F.lit(1)).alias("__n"))
                           .withColumn("__row", F.monotonically_increasing_id()), "profiles")
    narrow: DataFrame | None = None
    kinds = _by_type(df, measures)
    skip = not unknown and len(kinds) == 1  # then a profile without known cells need not come back at all
    for kind in kinds:
        below = F.col("__below")
        turned = [i for i, m in enumerate(kind) if m in descending]
        if turned:
            above = F.when(F.col("__v").isNull(), below).otherwise(F.col("__valid") - below - F.col("__ties"))
            below = F.when(F.col("__m").isin(turned), above).otherwise(below)
        ranks = value_ranks(profiles, keys, kind, "__n").select("__m", *keys, "__v", (
            share(below) if unknown else F.when(F.col("__v").isNotNull(), share(below))).alias("__share"))
        cells = _cells(profiles, ["__row", *keys], kind)
        if skip:
            cells, ranks = cells.where(F.col("__v").isNotNull()), ranks.where(F.col("__v").isNotNull())
        ranked = join_same(cells, ranks, ["__m", *keys, "__v"], "inner")

        def cell(column: str, i: int) -> Column:
            return F.max(F.when(F.col("__m") == i, F.col(column)))  # a profile has one cell per measure
        found = ranked.groupBy("__row").agg(
            *[F.first(k).alias(f"__key_{k}") for k in keys],
            *[cell("__v", i).alias(f"__own_{m}") for i, m in enumerate(kind)],
            *[cell("__share", i).alias(f"__share_{m}") for i, m in enumerate(kind)])
        if narrow is not None:
            found = narrow.join(found.drop(*[f"__key_{k}" for k in keys]), "__row")
        narrow = found
    match = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
    match += [F.col(m).eqNullSafe(F.col(f"__own_{m}")) for m in measures if m not in keys]
    joined = df.join(narrow.drop("__row"), reduce(lambda a, b: a & b, match), "left")
    return joined.withColumns({out: F.col(f"__share_{m}") for out, m in outputs.items()}).select(
        *df.columns, *[out for out in outputs if out not in df.columns])


def percent_ranks(df: DataFrame, keys: Sequence[str], outputs: Mapping[str, str]) -> DataFrame:
    """SQL ``PERCENT_RANK`` (ascending, NULL last) of several measures; ``outputs`` maps new name to measure."""
    def share(below: Column) -> Column:
        rest = F.col("__all") - 1
        return F.when(rest > 0, below / rest).otherwise(F.lit(0.0))
    return with_shares(df, keys, outputs, share)


def tie_percentiles(df: DataFrame, keys: Sequence[str], outputs: Mapping[str, str], descending: Sequence[str] = ()
                    ) -> DataFrame:
    """Average rank of ties over the number of known values, 0 to 1; NULL stays NULL."""
    def share(below: Column) -> Column:
        return (below + (F.col("__ties") + 1) / 2) / F.col("__valid")
    return with_shares(df, keys, outputs, share, descending, unknown=False)


def quantile_table(df: DataFrame, keys: Sequence[str], measures: Sequence[str], quantiles: Mapping[str, float]
                   ) -> DataFrame:
    """Exact interpolated quantiles per group and measure (``__m`` is its number), plus ``n``, ``min_value``,
    ``max_value`` and ``mean_value``."""
    numbers = df.select(*keys, *[F.col(m).cast("double").alias(m) for m in measures])
    ranks = value_ranks(numbers, keys, measures)
    value = F.col("__v")

    def value_at(place: Column) -> Column:
        covers = (F.col("__below") <= place) & (place < F.col("__below") + F.col("__ties")) & value.isNotNull()
        return F.max(F.when(covers, value))

    ends, points = [], {}
    for out, q in quantiles.items():
        place = (F.col("__valid") - 1) * F.lit(float(q))
        ends += [value_at(F.floor(place)).alias(f"__lo_{out}"), value_at(F.ceil(place)).alias(f"__hi_{out}")]
        part = (F.col("n") - 1) * F.lit(float(q))
        part = part - F.floor(part)
        points[out] = F.col(f"__lo_{out}") + (F.col(f"__hi_{out}") - F.col(f"__lo_{out}")) * part
    mean = F.sum(value * F.col("__ties")) / F.max("__valid")
    basic = [F.max("__valid").alias("n"), F.min("__v").alias("min_value"), F.max("__v").alias("max_value"),
             mean.alias("mean_value")]
    found = ranks.groupBy("__m", *keys).agg(*basic, *ends)
    return found.select("__m", *keys, "n", "min_value", "max_value", "mean_value",
                        *[c.alias(out) for out, c in points.items()])


def group_quantiles(df: DataFrame, keys: Sequence[str], measure: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group, plus ``n``, ``min_value``, ``max_value`` and ``mean_value``."""
    return quantile_table(df, keys, [measure], quantiles).drop("__m")


def value_neighbours(df: DataFrame, keys: Sequence[str], value: str, aggregates: Sequence[Column] = ()) -> DataFrame:
    """Distinct non-NULL values per group with the next lower (``__prev``) and next higher (``__next``) one.

    ``aggregates`` are computed per distinct value; ``__n`` counts its rows.
    """
    values = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(F.count(F.lit(1)).alias("__n"), *aggregates))
    stored = in_ranges(values, [*keys, value], "values")
    across = Window.partitionBy(*keys).orderBy("__range")
    edges = (stored.groupBy("__range", *keys).agg(F.min(value).alias("__min"), F.max(value).alias("__max"))
             .select("__range", *keys, F.lag("__max").over(across).alias("__before"),
                     F.lead("__min").over(across).alias("__after")))
    inside = Window.partitionBy("__range", *keys).orderBy("__place")
    local = stored.withColumns({"__prev": F.lag(value).over(inside), "__next": F.lead(value).over(inside)})
    joined = join_same(local, edges, ["__range", *keys])
    return joined.withColumns({"__prev": F.coalesce("__prev", "__before"), "__next": F.coalesce("__next", "__after")}
                              ).drop("__range", "__place", "__before", "__after")
