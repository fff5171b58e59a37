"""The wide panels and the scouting marts on top of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions import (cohort_flag, performance_tier, rate_or_zero, risk_rating, role_of, specialist_index,
                         squad_status, value_estimate)
from ..operators.metrics import add_derived_ratios, add_rates
from ..operators.panel import dim_entity, latest_known, period_change, specialist_join, wide_join
from ..operators.ranking import percent_ranks
from ..operators.shape import role_union

# Measures that each category brings into the wide panel.
WIDE_MEASURES = {
    "shooting": ["shots_total", "shots_on_target", "avg_shot_distance"],
    "passing": ["key_passes", "pass_progressive_distance", "passes_completed", "passes_into_penalty_area"],
    "pass_types": ["through_balls", "switches", "crosses"],
    "defensive_actions": ["tackles_won", "interceptions", "tackles_att_3rd", "shots_blocked"],
    "possession": ["carry_progressive_distance", "takeons_won", "touches", "touches_att_pen",
                   "carries_into_penalty_area"],
    "miscellaneous_stats": ["recoveries", "aerials_won", "aerials_lost", "fouls_committed", "fouls_drawn"],
    "goal_and_shot_creation": ["sca", "gca"],
    "playing_time": ["plus_minus", "plus_minus_per90"],
}
WIDE_NAMES = {"ball_recoveries": "recoveries", "shot_creating_actions": "sca", "goal_creating_actions": "gca"}
NOT_ZERO_FILLED = ["avg_shot_distance"]
SPECIALIST_MEASURES = {
    "goalkeeping": ["goals_against", "save_pct", "clean_sheet_pct", "pk_saved"],
    "advanced_goalkeeping": ["psxg", "psxg_plus_minus", "crosses_stopped_pct", "sweeper_actions",
                             "long_pass_completion_pct"],
}

# Measures summed into each rate, and the measure ranked by each percentile.
SCOUTING_RATES = {
    "goal_contribution_per_90": ["goals", "assists"],
    "expected_contribution_per_90": ["npxg", "xag"],
    "progression_total_dist_per_90": ["pass_progressive_distance", "carry_progressive_distance"],
    "defensive_actions_per_90": ["tackles_won", "interceptions", "recoveries"],
}
SCOUTING_PERCENTILES = {
    "percentile_attacking": "expected_contribution_per_90",
    "percentile_progression": "progression_total_dist_per_90",
    "percentile_defense": "defensive_actions_per_90",
}
KEEPER_PERCENTILES = {
    "percentile_shot_stopping": "psxg_plus_minus_per_90",
    "percentile_command": "crosses_stopped_pct",
    "percentile_sweeping": "sweeper_actions_per_90",
    "percentile_distribution": "long_pass_completion_pct",
}


def _measures(stages: Mapping[str, DataFrame], menu: Mapping[str, list[str]]) -> dict[str, DataFrame]:
    out = {}
    for category, wanted in menu.items():
        df = stages[category].withColumnsRenamed(WIDE_NAMES).withColumnRenamed(
            "defensive_actions_outside_pen_area", "sweeper_actions")
        out[category] = df.select(*V.PANEL_KEYS, *wanted)
    return out


def player_panel(stages: Mapping[str, DataFrame]) -> DataFrame:
    """One row per (player_id, squad, season_id) with the measures of all outfield categories."""
    base = stages["standard_stats"].drop("matches_played", "matches_started", "goals_assists", "penalties_made",
                                         "penalties_att", "progressive_receptions")
    parts = _measures(stages, WIDE_MEASURES)
    zeros = [m for names in WIDE_MEASURES.values() for m in names if m not in NOT_ZERO_FILLED]
    return wide_join(base, list(parts.values()), V.PANEL_KEYS, zeros)


def keeper_panel(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Panel of the entities that have goalkeeping statistics."""
    base = stages["standard_stats"].select(*V.PANEL_KEYS, "player_name", "nation", "competition", "age", "birth_year",
                                           "minutes_90s")
    parts = _measures(stages, SPECIALIST_MEASURES)
    return (specialist_join(base, parts["goalkeeping"], [parts["advanced_goalkeeping"]])
            .withColumn("primary_position", F.lit(V.KEEPER_POSITION)))


def scouting_rates(panel: DataFrame, min_exposure: float = V.MIN_EXPOSURE,
                   reference_year: int = V.COHORT_REFERENCE_YEAR) -> DataFrame:
    """Rows with enough exposure, their rates, cohort flag and role."""
    enough = panel.where(F.col("minutes_90s") >= min_exposure)
    return add_derived_ratios(add_rates(enough, SCOUTING_RATES)).withColumns({
        "is_u23_prospect": cohort_flag(F.col("birth_year"), reference_year),
        "scouting_role": role_of(F.col("primary_position")),
    })


def scouting_mart(panel: DataFrame, min_exposure: float = V.MIN_EXPOSURE,
                  reference_year: int = V.COHORT_REFERENCE_YEAR) -> DataFrame:
    """Rates with percentile ranks among peers of the same season and position."""
    return percent_ranks(scouting_rates(panel, min_exposure, reference_year), ["season_id", "primary_position"],
                         SCOUTING_PERCENTILES)


def keeper_rates(panel: DataFrame, min_exposure: float = V.MIN_EXPOSURE,
                 reference_year: int = V.COHORT_REFERENCE_YEAR) -> DataFrame:
    enough = panel.where(F.col("minutes_90s") >= min_exposure)
    return enough.withColumns({
        "psxg_plus_minus_per_90": rate_or_zero(F.col("psxg_plus_minus"), F.col("minutes_90s")),
        "sweeper_actions_per_90": rate_or_zero(F.col("sweeper_actions"), F.col("minutes_90s")),
        "is_u23_prospect": cohort_flag(F.col("birth_year"), reference_year),
        "scouting_role": F.lit("Goalkeeper"),
    })


def keeper_mart(panel: DataFrame, min_exposure: float = V.MIN_EXPOSURE,
                reference_year: int = V.COHORT_REFERENCE_YEAR) -> DataFrame:
    """Goalkeeper rates with percentile ranks inside the season."""
    return percent_ranks(keeper_rates(panel, min_exposure, reference_year), ["season_id"], KEEPER_PERCENTILES)


def combined_roles(scouting: DataFrame, keepers: DataFrame) -> DataFrame:
    """Outfield and goalkeeper rows in one shape with the specialist and the scoring index.

    Goalkeepers come from their own table only.
    """
    columns = ["player_id", "player_name", "season_id", "squad", "age", "primary_position", "minutes_90s", "goals",
               "npxg", "expected_contribution_per_90", "progression_total_dist_per_90", "defensive_actions_per_90",
               "gk_metric"]
    field = scouting.where(~F.col("primary_position").eqNullSafe(V.KEEPER_POSITION))
    rows = role_union(field.withColumn("goals", F.col("goals").cast("double")),
                      keepers.withColumn("gk_metric", F.col("psxg_plus_minus_per_90")), columns, columns[7:])
    index = specialist_index(F.col("primary_position"), F.col("progression_total_dist_per_90"),
                             F.col("defensive_actions_per_90"), F.col("gk_metric"),
                             F.col("expected_contribution_per_90"))
    return rows.withColumns({"specialist_index": index, "scoring_index": F.col("expected_contribution_per_90")})


def trends_mart(scouting: DataFrame, keepers: DataFrame) -> DataFrame:
    """Indices per entity and period with their change from the previous row."""
    changed = period_change(combined_roles(scouting, keepers), "player_id", ["season_id", "squad"], {
        "yoy_change_specialist": "specialist_index", "yoy_change_scoring": "scoring_index"})
    return changed.select("player_id", "player_name", "season_id", "squad", "primary_position", "age",
                          "specialist_index", "scoring_index", "goals", "npxg", "yoy_change_specialist",
                          "yoy_change_scoring")


def consistency_mart(trends: DataFrame, volatility_limit: float = V.VOLATILITY_LIMIT,
                     form_limit: float = V.FORM_LIMIT) -> DataFrame:
    """Seasons tracked, volatility, peak, current form and risk label of every entity."""
    form = latest_known("specialist_index", "season_id", "squad") - F.avg("specialist_index")
    stats = trends.groupBy("player_id", "player_name", "primary_position").agg(
        F.count_distinct("season_id").alias("seasons_tracked"),
        F.stddev_samp("specialist_index").alias("performance_volatility"),
        F.max("specialist_index").alias("career_peak_performance"),
        form.alias("form_vs_avg"))
    rating = risk_rating(F.col("seasons_tracked"), F.col("performance_volatility"), F.col("form_vs_avg"),
                         volatility_limit, form_limit)
    return stats.withColumn("transfer_risk_rating", rating)


def squad_profile_mart(scouting: DataFrame, starter_exposure: float = V.STARTER_EXPOSURE) -> DataFrame:
    """Depth, age and starter averages per squad, season, competition and position."""
    def starters(measure: str):
        return F.avg(F.when(F.col("minutes_90s") > starter_exposure, F.col(measure)))
    return scouting.groupBy("squad", "season_id", "competition", "primary_position").agg(
        F.count_distinct("player_id").alias("depth_count"), F.avg("age").alias("avg_age"),
        starters("expected_contribution_per_90").alias("starter_avg_xg_xag"),
        starters("progression_total_dist_per_90").alias("starter_avg_progression"),
        starters("defensive_actions_per_90").alias("starter_avg_def_actions"))


def valuation_mart(scouting: DataFrame) -> DataFrame:
    """Tier, value estimate and squad status, one row per scouting row."""
    return scouting.select(
        "player_id", "player_name", "season_id", "squad", "age",
        performance_tier(F.col("percentile_attacking"), F.col("percentile_defense")).alias("performance_tier"),
        value_estimate(F.col("expected_contribution_per_90"), F.col("defensive_actions_per_90"), F.col("age"),
                       F.col("competition")).alias("market_value_est_m_eur"),
        squad_status(F.col("minutes_90s")).alias("squad_status"))


def players_dim(panel: DataFrame) -> DataFrame:
    """One row per player: latest name, nation and position, highest birth year."""
    return dim_entity(panel, "player_id", ["player_name", "nation", "primary_position"], ["birth_year"])
