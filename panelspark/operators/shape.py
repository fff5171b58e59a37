"""Projection, reshaping, union and deduplication."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..fixed_values import SOURCE_COLUMN
from ..functions.text import slugify_text


def filtered_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Column names without the excluded ones (any letter case)."""
    unwanted = {c.lower() for c in exclude}
    return [c for c in df.columns if c.lower() not in unwanted]


def star(df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "",
         relation_alias: str | None = None) -> list[Column]:
    """All columns but the excluded ones, for use in ``select`` or ``groupBy``."""
    owner = f"{relation_alias}." if relation_alias else ""
    return [F.col(f"{owner}`{c}`").alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, exclude)]


def nullcheck(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty text becomes NULL, in all text columns or the given ones."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(*[
        F.nullif(F.col(f.name), F.lit("")).alias(f.name)
        if f.name in wanted and isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema
    ])


def group_by_first(df: DataFrame, n: int):
    """``GROUP BY 1, ..., n``."""
    return df.groupBy(*df.columns[:n])


COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def pivot_columns(column: str, values: Sequence, agg: Callable[[Column], Column] = F.sum, cmp: str = "=",
                  prefix: str = "", suffix: str = "", then_value=1, else_value=0, quote_identifiers: bool = True,
                  distinct: bool = False) -> list[Column]:
    """One conditional aggregate per value, for use in ``groupBy(...).agg(*...)``.

    All values share one aggregation, so a pivot costs one shuffle of partial sums.
    ``then_value`` and ``else_value`` may be columns.
    """
    def operand(v):
        return v if isinstance(v, Column) else F.lit(v)

    out = []
    for value in values:
        hit = F.when(COMPARISONS[cmp](F.col(column), F.lit(value)), operand(then_value)).otherwise(operand(else_value))
        if distinct:
            name = getattr(agg, "__name__", str(agg))
            measure = {"sum": F.sum_distinct, "count": F.count_distinct}.get(name, agg)(hit)
        else:
            measure = agg(hit)
        label = f"{prefix}{value}{suffix}"
        out.append(measure.alias(label if quote_identifiers else slugify_text(label)))
    return out


def unpivot(df: DataFrame, cast_to: str = "string", exclude: Sequence[str] = (), remove: Sequence[str] = (),
            field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """Columns to rows; ``exclude`` columns stay as identifiers, ``remove`` columns vanish, NULL values stay."""
    kept = {c.lower() for c in exclude}
    ids = [c for c in df.columns if c.lower() in kept]
    fields = filtered_columns(df, [*exclude, *remove])
    cast = df.select(*ids, *[F.col(c).cast(cast_to).alias(c) for c in fields])
    return cast.unpivot(ids, fields, field_name, value_name)


def union_relations(relations: Mapping[str, DataFrame], column_override: Mapping[str, str] | None = None,
                    include: Sequence[str] = (), exclude: Sequence[str] = (),
                    source_column_name: str | None = SOURCE_COLUMN, where: str | None = None) -> DataFrame:
    """UNION ALL of named relations over the superset of their columns.

    Columns appear in first-seen order with the type of the first relation that has
    them; a relation without a column gives NULL.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    wanted = {c.lower() for c in include}
    unwanted = {c.lower() for c in exclude}
    types: dict[str, T.DataType] = {}
    for df in relations.values():
        for field in df.schema:
            name = field.name.lower()
            if (not wanted or name in wanted) and name not in unwanted:
                types.setdefault(field.name, field.dataType)
    if (include or exclude) and not types:
        raise ValueError(f"no columns left to union for {', '.join(relations)}")
    types = {c: (column_override or {}).get(c, t) for c, t in types.items()}

    def branch(name: str, df: DataFrame) -> DataFrame:
        rows = df.where(where) if where else df
        source = [] if source_column_name is None else [F.lit(name).alias(source_column_name)]
        own = set(df.columns)
        return rows.select(*source, *[(F.col(c) if c in own else F.lit(None)).cast(t).alias(c)
                                      for c, t in types.items()])

    return reduce(DataFrame.union, [branch(n, df) for n, df in relations.items()])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tag_period(df: DataFrame, period: Column, period_column: str = "source_season_id") -> DataFrame:
    """Rows of all periods of one table in a single scan, each tagged with its period."""
    return df.withColumn(period_column, period.cast("string"))


def union_periods(frames: Mapping[str, DataFrame], period_column: str = "source_season_id") -> DataFrame:
    """Stack equally shaped frames of several periods and tag each row with its period."""
    return reduce(DataFrame.unionByName, [df.withColumn(period_column, F.lit(p)) for p, df in frames.items()])


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row per key. Rows holding NULLs are kept.

    The planner limits each group inside every map task before the shuffle
    (WindowGroupLimit), so a hot key ships one row per task.
    """
    first = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def latest_row(df: DataFrame, keys: Sequence[str], *period: str) -> DataFrame:
    """Row of the last period of every key (ties by the further ``period`` columns)."""
    return deduplicate(df, keys, [F.col(p).desc_nulls_last() for p in period])


def column_values(df: DataFrame | None, column: str, order_by: Sequence[Column] | None = None,
                  max_records: int | None = None, where: str | None = None) -> DataFrame:
    """Distinct values of a column with their counts, most frequent first (ties by value)."""
    rows = df.where(where) if where else df
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(*(order_by or [F.desc("n"), F.asc_nulls_last("value")]))
    return ordered if max_records is None else ordered.limit(max_records)


def pivot_map(df: DataFrame, keys: Sequence[str | Column], column: str, aggregate: Column | None = None) -> DataFrame:
    """Per group a map from every value of ``column`` that occurs to its aggregate (row count if not given).

    The pivot over values that nobody listed: they become map keys, not columns, so no list of them is needed.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    cells = df.groupBy(*keys, F.col(column).alias("__key")).agg(
        (F.count(F.lit(1)) if aggregate is None else aggregate).alias("__value"))
    names = [c for c in cells.columns if c not in ("__key", "__value")]
    entries = F.array_sort(F.collect_list(F.struct("__key", "__value")))
    return cells.where(F.col("__key").isNotNull()).groupBy(*names).agg(F.map_from_entries(entries).alias(column))


def column_value_list(df: DataFrame | None, column: str, default: list | None = None, **options) -> list | None:
    """``column_values`` as a Python list, e.g. for a pivot; ``default`` when there is nothing to read.

    For columns whose values make column names; ``max_records`` keeps the most frequent ones. For all others there is
    ``pivot_map``.
    """
    if df is None:
        if default is None:
            raise ValueError("the relation does not exist and no default was given")
        return default
    return [r["value"] for r in column_values(df, column, **options).collect()] or default


def single_value(df: DataFrame, default=None):
    """First column of the first row; ``default`` only when there is no row."""
    row = df.first()
    return default if row is None else row[0]


def results_as_dict(df: DataFrame) -> dict[str, list]:
    """Column name to list of values, for results that are read by a program on the driver."""
    rows = df.collect()
    return {c: [r[c] for r in rows] for c in df.columns}


def role_union(outfield: DataFrame, keepers: DataFrame, columns: Sequence[str], zeros: Sequence[str]) -> DataFrame:
    """Stack two kinds of entities; each measure missing on one side counts 0.0."""
    def side(df: DataFrame) -> DataFrame:
        own = set(df.columns)
        return df.select(*[F.col(c) if c in own else F.lit(0.0).alias(c) if c in zeros else F.lit(None).alias(c)
                           for c in columns])
    return side(outfield).unionByName(side(keepers))
