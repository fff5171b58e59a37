"""Relations, columns and data profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .joins import with_one_row

_LISTING = T.StructType([T.StructField("table_schema", T.StringType()), T.StructField("table_name", T.StringType()),
                         T.StructField("table_type", T.StringType())])


def list_relations(spark: SparkSession, schema_pattern: str = "%") -> DataFrame:
    """(table_schema, table_name, table_type) of the tables and views the session knows."""
    rows = []
    for db in spark.catalog.listDatabases():
        rows += [(db.name, t.name, "view" if "VIEW" in (t.tableType or "") else "table")
                 for t in spark.catalog.listTables(db.name) if not t.isTemporary]
    rows += [("", t.name, "view") for t in spark.catalog.listTables() if t.isTemporary]
    return spark.createDataFrame(rows, _LISTING).where(F.col("table_schema").ilike(schema_pattern)).distinct()


def relations_by_pattern(spark: SparkSession, table_pattern: str, exclude: str = "",
                         schema_pattern: str = "%") -> DataFrame:
    """Relations whose name matches a LIKE pattern in any letter case, minus those matching ``exclude``."""
    found = list_relations(spark, schema_pattern).where(F.col("table_name").ilike(table_pattern))
    return found.where(~F.col("table_name").ilike(exclude)) if exclude else found


def relations_by_prefix(spark: SparkSession, prefix: str, exclude: str = "", schema_pattern: str = "%") -> DataFrame:
    """Relations whose name starts with ``prefix`` (any letter case)."""
    found = list_relations(spark, schema_pattern).where(F.lower("table_name").startswith(prefix.lower()))
    return found.where(~F.col("table_name").ilike(exclude)) if exclude else found


def read_relations(spark: SparkSession, listing: DataFrame) -> dict[str, DataFrame]:
    """Listed relations as DataFrames by name, in name order. A listing is catalog metadata."""
    rows = listing.orderBy("table_schema", "table_name").collect()
    return {r.table_name: spark.table(f"`{r.table_schema}`.`{r.table_name}`" if r.table_schema else f"`{r.table_name}`")
            for r in rows}


def column_inventory(tables: Mapping[str, DataFrame], primary: str = "player_id") -> DataFrame:
    """(table_name, ordinal_position, column_name, data_type, key_flags, n_rows, n_filled), one pass per table."""
    out = None
    for name, df in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("__all"), *[F.count(c).alias(c) for c in df.columns])
        entries = []
        for i, f in enumerate(df.schema, 1):
            flags = "PK,FK" if f.name == primary else "FK" if f.name.endswith("_id") else ""
            entries.append(F.struct(
                F.lit(name).alias("table_name"), F.lit(i).alias("ordinal_position"), F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(flags).alias("key_flags"),
                F.col("__all").alias("n_rows"), F.col(f.name).alias("n_filled")))
        rows = counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def null_profile(df: DataFrame, table_name: str = "table") -> DataFrame:
    """(table_name, row_count, column_name, data_type, null_count, null_pct) from one aggregation."""
    counts = df.agg(F.count(F.lit(1)).alias("__all"), *[F.count(c).alias(f"__f_{i}") for i, c in enumerate(df.columns)])

    def entry(i: int, f: T.StructField):
        nulls = F.col("__all") - F.col(f"__f_{i}")
        share = F.when(F.col("__all") > 0, F.round(nulls * 100.0 / F.col("__all"), 2)).otherwise(F.lit(0.0))
        return F.struct(F.lit(table_name).alias("table_name"), F.col("__all").alias("row_count"),
                        F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                        nulls.alias("null_count"), share.cast("double").alias("null_pct"))

    entries = [entry(i, f) for i, f in enumerate(df.schema)]
    return counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def browse(df: DataFrame, n: int = 100, order: Sequence[str] = ()) -> DataFrame:
    """The first n rows of a table, each with the table's total row count."""
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    shown = (df.orderBy(*order) if order else df).limit(n)
    return with_one_row(shown, total)


def period_row_counts(df: DataFrame, period: str = "season_id") -> DataFrame:
    return df.groupBy(period).agg(F.count(F.lit(1)).alias("n_rows"))


def load_audit(df: DataFrame, n_tables: int, period: str = "season_id", main_period=None,
               fallback_period=None) -> DataFrame:
    """Rows of the main period (else of the fallback, else 0) and the number of raw tables.

    Without named periods the newest one counts.
    """
    counts = period_row_counts(df, period)
    if main_period is None:
        newest = counts.agg(F.max_by("n_rows", period).alias("n"))
    else:
        def rows_of(p):
            return F.max(F.when(F.col(period) == p, F.col("n_rows")))
        newest = counts.agg(F.coalesce(rows_of(main_period), rows_of(fallback_period)).alias("n"))
    return newest.select(F.coalesce("n", F.lit(0)).alias("main_rows"), F.lit(n_tables).alias("n_tables"))
