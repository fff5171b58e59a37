"""Number and date series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_STEP = {"second": "SECOND", "minute": "MINUTE", "hour": "HOUR", "day": "DAY", "week": "WEEK", "month": "MONTH", "quarter": "MONTH", "year": "YEAR"}
_TIMES = {"quarter": 3}
STRETCH = 65_536  # steps that one row of the spine's plan unfolds


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1..upper_bound as ``generated_number``."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def intervals_between(start: Column, end: Column, datepart: str) -> Column:
    """Boundaries of ``datepart`` crossed from start to end; weeks are whole seven-day steps."""
    if datepart not in _STEP:
        raise ValueError(f"unsupported datepart {datepart!r}")
    if datepart == "day":
        return F.datediff(end, start).cast("bigint")
    if datepart == "week":
        return (F.datediff(end, start) / 7).cast("bigint")
    if datepart in ("second", "minute", "hour"):
        return F.timestamp_diff(_STEP[datepart], F.date_trunc(datepart, start), F.date_trunc(datepart, end))
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    if datepart == "month":
        return months.cast("bigint")
    if datepart == "quarter":
        return ((F.year(end) - F.year(start)) * 4 + F.quarter(end) - F.quarter(start)).cast("bigint")
    return (F.year(end) - F.year(start)).cast("bigint")


def date_spine(bounds: DataFrame, datepart: str, start: str = "start", end: str = "end") -> DataFrame:
    """One row ``date_<datepart>`` per step from start up to, but without, end.

    ``bounds`` holds one row with the two limits, so they may come from an aggregate. Steps are made in stretches of
    bounded size, so that a spine of seconds over years is spread over tasks.
    """
    steps = intervals_between(F.col(start), F.col(end), datepart)
    origin = F.col(start).cast("timestamp_ntz")
    stretch = F.explode(F.sequence(F.lit(0).cast("bigint"), steps - 1, F.lit(STRETCH).cast("bigint")))
    stretches = (bounds.where(steps > 0).select(origin.alias("__o"), (steps - 1).alias("__last"), stretch.alias("__from"))
                 .hint("rebalance"))
    index = F.explode(F.sequence(F.col("__from"), F.least(F.col("__last"), F.col("__from") + (STRETCH - 1))))
    step = F.expr(f"INTERVAL 1 {_STEP[datepart]}") * (F.col("__i") * _TIMES.get(datepart, 1)).cast("int")
    return (stretches.select("__o", index.alias("__i"))
            .select((F.col("__o") + step).alias(f"date_{datepart}")))
