"""Rates, scores, reference lines and leaderboards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from ..functions import quadrant, rate_or_zero
from .joins import join_same
from .ranking import group_quantiles, quantile_table, tie_percentiles


def add_rates(df: DataFrame, rates: Mapping[str, Sequence[str]], exposure: str = "minutes_90s") -> DataFrame:
    """Sum of measures per unit of exposure; 0 without exposure."""
    def total(names):
        return reduce(lambda a, b: a + b, [F.col(n) for n in names])
    return df.withColumns({out: rate_or_zero(total(names), F.col(exposure)) for out, names in rates.items()})


def add_rates_compat(df: DataFrame, rates: Mapping[str, Sequence[str]], exposure: str = "minutes_90s") -> DataFrame:
    """As ``add_rates``, but only the last measure is divided by the exposure."""
    def total(names):
        last = F.col(names[-1]) / F.col(exposure)
        return reduce(lambda a, b: a + b, [*[F.col(n) for n in names[:-1]], last])
    empty = F.col(exposure).isNull() | (F.col(exposure) == 0)
    return df.withColumns({out: F.when(empty, F.lit(0.0)).otherwise(total(names).cast("double"))
                           for out, names in rates.items()})


def add_derived_ratios(df: DataFrame) -> DataFrame:
    """Finishing, shot quality and aerial success, as far as their inputs exist."""
    own = set(df.columns)
    ratios = {
        "goals_vs_xg": (("goals", "xg"), lambda a, b: a - b),
        "npxg_per_shot": (("npxg", "shots_total"), F.try_divide),
        "aerial_win_pct": (("aerials_won", "aerials_lost"), lambda a, b: F.try_divide(a * 100, a + b)),
    }
    return df.withColumns({out: rule(F.col(a), F.col(b)) for out, ((a, b), rule) in ratios.items() if {a, b} <= own})


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean of the non-NULL values of a row; NULL if there are none."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])
    known = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])
    return F.try_divide(total, known)


def composite_score(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], out: str = "overall_score") -> DataFrame:
    """Mean peer percentile (0 to 100) over the metrics that exist; 0 when none does."""
    present = [m for m in metrics if m in df.columns]
    if not present:
        return df.withColumn(out, F.lit(0.0))
    ranked = tie_percentiles(df, keys, {f"__pct_{m}": m for m in present})
    score = row_mean([F.col(f"__pct_{m}") for m in present]) * 100
    return ranked.withColumn(out, score).drop(*[f"__pct_{m}" for m in present])


def role_scores(df: DataFrame, keys: Sequence[str] = (), role: str = "scouting_role", out: str = "overall_score",
                kpis: Mapping[str, Mapping] = V.ROLE_KPIS) -> DataFrame:
    """Composite score of every row by the scoring metrics of its role, among rows of that role.

    All roles are ranked in one pass: slot i holds the role's i-th metric, NULL for roles that
    lack it, and ranks are taken inside (keys, role).
    """
    own = set(df.columns)
    menus = {r: [m for m in cfg["scoring"] if m in own] for r, cfg in kpis.items()}
    width = max(len(m) for m in menus.values())
    slots = {}
    for i in range(width):
        choice = F.lit(None).cast("double")
        for r, metrics in menus.items():
            if i < len(metrics):
                choice = F.when(F.col(role) == r, F.col(metrics[i]).cast("double")).otherwise(choice)
        slots[f"__slot{i}"] = choice
    scored = composite_score(df.withColumns(slots), [*keys, role], list(slots), out)
    return scored.withColumn(out, F.coalesce(out, F.lit(0.0))).drop(*slots)


def role_axes(df: DataFrame, role: str = "scouting_role", kpis: Mapping[str, Mapping] = V.ROLE_KPIS) -> DataFrame:
    """Add ``kpi_x``, ``kpi_y`` and ``kpi_size``: the measures by which the row's role is charted."""
    own = set(df.columns)

    def measure(axis: str) -> Column:
        choice = F.lit(None).cast("double")
        for r, cfg in kpis.items():
            if cfg[axis] in own:
                choice = F.when(F.col(role) == r, F.col(cfg[axis]).cast("double")).otherwise(choice)
        return choice
    return df.withColumns({f"kpi_{axis}": measure(axis) for axis in ("x", "y", "size")})


def group_mean(df: DataFrame, keys: Sequence[str], score: str, out: str) -> DataFrame:
    """Mean score per group, e.g. of a squad inside a peer group."""
    return df.groupBy(*keys).agg(F.avg(score).alias(out))


def reference_lines(df: DataFrame, keys: Sequence[str], x: str, y: str, baseline: str = "mean") -> DataFrame:
    """Mean or median of two measures per group."""
    if baseline == "mean":
        return df.groupBy(*keys).agg(F.avg(x).alias("x_line"), F.avg(y).alias("y_line"))
    if baseline != "median":
        raise ValueError("baseline must be 'mean' or 'median'")
    medians = quantile_table(df, keys, [x, y], {"line": 0.5})
    lines = [F.max(F.when(F.col("__m") == i, F.col("line"))).alias(out) for i, out in enumerate(("x_line", "y_line"))]
    return medians.groupBy(*keys).agg(*lines)


def quadrants(df: DataFrame, keys: Sequence[str], x: str, y: str, baseline: str = "mean") -> DataFrame:
    """Add the reference lines of the group and the quadrant of every row."""
    lined = join_same(df, reference_lines(df, keys, x, y, baseline), keys)
    return lined.withColumn("quadrant", quadrant(F.col(x), F.col(y), F.col("x_line"), F.col("y_line")))


def group_distribution(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Count, range, mean and exact quartiles of a measure per group."""
    return group_quantiles(df, keys, measure, {"q1": 0.25, "median": 0.5, "q3": 0.75})


def leaderboard(df: DataFrame, score: str, n: int = 10, tie_break: Sequence[str] = ()) -> DataFrame:
    """The n best rows; planned as a per-task top-n followed by a merge."""
    return df.orderBy(F.col(score).desc_nulls_last(), *tie_break).limit(n)


def undervalued(df: DataFrame, n: int = 10, below: float = V.UNDERVALUED_BELOW,
                tiers: Sequence[str] = (V.TIER_S, V.TIER_A), tie_break: Sequence[str] = ()) -> DataFrame:
    """The n cheapest rows of the best tiers under a value limit."""
    cheap = df.where(F.col("performance_tier").isin(list(tiers)) & (F.col("market_value_est_m_eur") < below))
    return cheap.orderBy(F.col("market_value_est_m_eur").asc_nulls_last(), *tie_break).limit(n)


def newest_rows(df: DataFrame, stamp: str, n: int = 20, tie_break: Sequence[Column] = ()) -> DataFrame:
    return df.orderBy(F.col(stamp).desc_nulls_last(), *tie_break).limit(n)
