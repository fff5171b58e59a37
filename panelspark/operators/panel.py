"""Wide panel, dimension and facets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as V


def wide_join(base: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str] = tuple(V.PANEL_KEYS),
              zero_fill: Sequence[str] = ()) -> DataFrame:
    """LEFT JOIN measure tables of the same grain to ``base``; named measures become 0 when absent.

    Every join uses the same keys, so after the first one the left side keeps its partitioning.
    """
    out = base.where(F.col(keys[0]).isNotNull())
    for part in parts:
        out = out.join(part, list(keys), "left")
    fill = set(zero_fill)
    return out.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in fill else F.col(c) for c in out.columns])


def specialist_join(base: DataFrame, specialist: DataFrame, extra: Sequence[DataFrame] = (),
                    keys: Sequence[str] = tuple(V.PANEL_KEYS)) -> DataFrame:
    """Keep only entities of the specialist table, then LEFT JOIN further tables."""
    out = base.join(specialist, list(keys), "inner")
    for part in extra:
        out = out.join(part, list(keys), "left")
    return out


def latest_known(value: str, *order: str) -> Column:
    """Value of the last period in which it is known; ties go to the greatest of the further columns."""
    known = F.col(value).isNotNull()
    return F.max_by(F.when(known, F.col(value)), F.when(known, F.struct(*order)))


def dim_entity(panel: DataFrame, key: str, latest: Sequence[str], highest: Sequence[str],
               order: Sequence[str] = ("season_id", "squad")) -> DataFrame:
    """One row per entity: most recent known attributes and maxima."""
    return panel.groupBy(key).agg(*[latest_known(c, *order).alias(c) for c in latest],
                                  *[F.max(c).alias(c) for c in highest])


def period_change(df: DataFrame, entity: str, order: Sequence[str], outputs: Mapping[str, str]) -> DataFrame:
    """Measure minus its value in the entity's previous row.

    An entity has at most one row per period and group, so its window stays small.
    """
    history = Window.partitionBy(entity).orderBy(*order)
    return df.withColumns({out: F.col(m) - F.lag(m).over(history) for out, m in outputs.items()})


def serving_join(scouting: DataFrame, valuation: DataFrame, consistency: DataFrame) -> DataFrame:
    """Scouting rows with their value estimate (full grain) and the entity's consistency."""
    value = valuation.select(*V.PANEL_KEYS, "market_value_est_m_eur", "performance_tier", "squad_status")
    risk = consistency.select("player_id", "primary_position", "transfer_risk_rating", "performance_volatility")
    return (scouting.join(value, V.PANEL_KEYS, "left")
            .join(risk, ["player_id", "primary_position"], "left"))


def facet_filter(df: DataFrame, seasons: Sequence | None = None, leagues: Sequence | None = None,
                 squads: Sequence | None = None, ages: tuple[int, int] | None = None, under_23: bool = False,
                 role: str | None = None) -> DataFrame:
    """Conjunction of the chosen facets; a facet whose column is missing does not filter."""
    own = set(df.columns)
    conditions = []
    for column, chosen in (("season_id", seasons), ("competition", leagues), ("squad", squads)):
        if chosen and column in own:
            conditions.append(F.col(column).isin(list(chosen)))
    if ages and "age" in own:
        conditions.append(F.col("age").between(*ages))
    if under_23 and "is_u23_prospect" in own:
        conditions.append(F.col("is_u23_prospect"))
    elif under_23 and "age" in own:
        conditions.append(F.col("age") <= V.COHORT_MAX_AGE)
    if role and "scouting_role" in own:
        conditions.append(F.col("scouting_role") == role)
    for condition in conditions:
        df = df.where(condition)
    return df


def facet_values(df: DataFrame, leagues: Sequence | None = None) -> DataFrame:
    """(facet, value) sorted per facet: seasons newest first, leagues, squads of the chosen leagues, age limits."""
    low, high = V.FALLBACK_AGES
    chosen = F.col("competition").isin(list(leagues)) if leagues else F.lit(True)
    pairs = F.explode(F.array(
        F.struct(F.lit("season").alias("facet"), F.col("season_id").cast("string").alias("value")),
        F.struct(F.lit("league").alias("facet"), F.col("competition").alias("value")),
        F.struct(F.lit("squad").alias("facet"), F.when(chosen, F.col("squad")).alias("value"))))
    domain = (df.select("season_id", "competition", "squad").distinct()
              .select(pairs.alias("p")).select("p.*").where("value IS NOT NULL").distinct())
    ages = (df.agg(F.coalesce(F.min("age"), F.lit(low)).alias("min_age"),
                   F.coalesce(F.max("age"), F.lit(high)).alias("max_age"))
            .unpivot([], ["min_age", "max_age"], "facet", "value")
            .select("facet", F.col("value").cast("string").alias("value")))
    newest = F.when(F.col("facet") == "season", F.col("value")).desc_nulls_last()
    return domain.unionByName(ages).orderBy("facet", newest, "value")


def entity_history(entity: Column, preferred: DataFrame, fallback: DataFrame, columns: Sequence[str],
                   order: Sequence[str] = ("season_id", "squad")) -> DataFrame:
    """All rows of one entity by period, from the preferred table if it is there, else from the other."""
    def side(df: DataFrame, priority: int) -> DataFrame:
        own = set(df.columns)
        return df.where(entity).select(F.lit(priority).alias("__priority"),
                                       *[F.col(c) if c in own else F.lit(None).alias(c) for c in columns])
    rows = side(preferred, 1).unionByName(side(fallback, 2))
    best = rows.agg(F.min("__priority")).scalar()
    return rows.where(F.col("__priority") == best).drop("__priority").orderBy(*order)
