"""Queries on the panel read from the order tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions import cohort_flag, entity_key, role_of, squad_status, surrogate_key
from ..operators import compare, metrics, panel as P, ranking, shape, similarity
from ..operators.joins import join_same
from ..operators.nations import display_nation, flag_code, iso_countries
from ..plans import marts as M
from ..session import materialize, new_path
from ..sources.files import refresh_period, save_mart, stamp_load
from .registry import q9, query, r9, table
from .tpch import (KEEPER_COLUMNS, KEEPERS_SQL, PANEL_COLUMNS, PANEL_SQL, PERSONS_SQL, RATED_SQL, ROLE_SQL,
                   SCOUTING_SQL, both_panels, counted_parts, keeper_panel, panel, persons)

KEYS = V.PANEL_KEYS
RATES = list(M.SCOUTING_RATES)
PERCENTILES = list(M.SCOUTING_PERCENTILES)
KEEPER_PERCENTILES = list(M.KEEPER_PERCENTILES)


def stored_panel(spark, sf):
    """The panel, computed once for plans that read it more than once."""
    return materialize(panel(spark, sf), "panel")


def scouting(spark, sf):
    return M.scouting_mart(stored_panel(spark, sf))


def rated(spark, sf):
    return M.scouting_rates(panel(spark, sf))


def stored_rated(spark, sf):
    return M.scouting_rates(stored_panel(spark, sf))


def keepers(spark, sf):
    return M.keeper_mart(materialize(keeper_panel(spark, sf), "keepers"))


def rated_keepers(spark, sf):
    return M.keeper_rates(keeper_panel(spark, sf))


def rounded(names):
    return [r9(n) for n in names]


def rounded_sql(names):
    return ", ".join(q9(n) for n in names)


# --- keys, dimension, wide panels -------------------------------------------

@query("entity_key", f"""WITH {PERSONS_SQL}
SELECT c_custkey, player_id AS entity_key FROM persons""")
def entity_key_query(spark, sf):
    p = persons(spark, sf)
    return p.select("c_custkey", entity_key(F.col("player_name"), F.col("birth_year"), F.col("nation")).alias("entity_key"))


@query("surrogate_key", f"""SELECT o_orderkey,
  md5(concat(coalesce(CAST(o_custkey AS VARCHAR), '{V.SURROGATE_NULL}'), '-',
             coalesce(nullif(o_orderstatus, 'P'), '{V.SURROGATE_NULL}'))) AS with_token,
  md5(concat(coalesce(CAST(o_custkey AS VARCHAR), ''), '-', coalesce(nullif(o_orderstatus, 'P'), ''))) AS with_empty
FROM orders""")
def surrogate_key_query(spark, sf):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, sf, "orders").select(
        "o_orderkey", surrogate_key([F.col("o_custkey"), status]).alias("with_token"),
        surrogate_key([F.col("o_custkey"), status], nulls_as_empty=True).alias("with_empty"))


@query("dim_entity", f"""WITH {PANEL_SQL}
SELECT player_id, arg_max(player_name, (season_id, squad)) AS player_name,
  arg_max(nation, (season_id, squad)) FILTER (WHERE nation IS NOT NULL) AS nation,
  arg_max(primary_position, (season_id, squad)) AS primary_position, max(birth_year) AS birth_year
FROM panel GROUP BY player_id""")
def dim_entity(spark, sf):
    return M.players_dim(panel(spark, sf))


_WIDE = """line_part AS (SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
base AS (SELECT o_custkey, o_orderpriority AS squad, CAST(year(o_orderdate) AS VARCHAR) AS season_id,
  count(*) AS n_lines, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS goals
  FROM line_part GROUP BY ALL),
shooting AS (SELECT o_custkey, o_orderpriority AS squad, CAST(year(o_orderdate) AS VARCHAR) AS season_id,
  CAST(count(*) AS BIGINT) AS shots_total, CAST(sum(CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END) AS BIGINT) AS shots_on_target
  FROM line_part WHERE l_quantity > 25 GROUP BY ALL),
defence AS (SELECT o_custkey, o_orderpriority AS squad, CAST(year(o_orderdate) AS VARCHAR) AS season_id,
  CAST(count(*) AS BIGINT) AS tackles_won FROM line_part WHERE l_tax >= 0.04 GROUP BY ALL),
aerial AS (SELECT o_custkey, o_orderpriority AS squad, CAST(year(o_orderdate) AS VARCHAR) AS season_id,
  CAST(count(*) AS BIGINT) AS aerials_won, CAST(sum(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) AS BIGINT) AS aerials_lost
  FROM line_part WHERE l_linenumber >= 6 GROUP BY ALL)"""
_GRAIN = ["o_custkey", "squad", "season_id"]


@query("wide_panel", f"""WITH {_WIDE}
SELECT o_custkey, squad, season_id, n_lines, goals, coalesce(shots_total, 0) AS shots_total,
  coalesce(shots_on_target, 0) AS shots_on_target, coalesce(tackles_won, 0) AS tackles_won, aerials_won, aerials_lost
FROM base LEFT JOIN shooting USING (o_custkey, squad, season_id) LEFT JOIN defence USING (o_custkey, squad, season_id)
LEFT JOIN aerial USING (o_custkey, squad, season_id)""")
def wide_panel(spark, sf):
    base, shooting, defence, aerial = counted_parts(spark, sf, [
        (("n_lines", "goals"), "true"), (("shots_total", "shots_on_target"), "l_quantity > 25"),
        (("tackles_won",), "l_tax >= 0.04"), (("aerials_won", "aerials_lost"), "l_linenumber >= 6")])
    return P.wide_join(base, [shooting, defence, aerial], _GRAIN, ["shots_total", "shots_on_target", "tackles_won"])


@query("specialist_panel", f"""WITH {_WIDE}
SELECT o_custkey, squad, season_id, goals, shots_total, shots_on_target, aerials_won, aerials_lost
FROM base JOIN shooting USING (o_custkey, squad, season_id) LEFT JOIN aerial USING (o_custkey, squad, season_id)""")
def specialist_panel(spark, sf):
    base, shooting, aerial = counted_parts(spark, sf, [
        (("goals",), "true"), (("shots_total", "shots_on_target"), "l_quantity > 25"),
        (("aerials_won", "aerials_lost"), "l_linenumber >= 6")])
    return P.specialist_join(base, shooting, [aerial], _GRAIN)


# --- rates, ranks, scores -----------------------------------------------------

@query("rate_metrics", f"WITH {RATED_SQL} SELECT player_id, squad, season_id, {rounded_sql(RATES)} FROM rated")
def rate_metrics(spark, sf):
    return rated(spark, sf).select(*KEYS, *rounded(RATES))


@query("rate_metrics_compat", f"""WITH {PANEL_SQL}
SELECT player_id, squad, season_id,
  {q9("goals + assists / minutes_90s", "goal_contribution_per_90")},
  {q9("npxg + xag / minutes_90s", "expected_contribution_per_90")},
  {q9("pass_progressive_distance + carry_progressive_distance / minutes_90s", "progression_total_dist_per_90")},
  {q9("tackles_won + interceptions + recoveries / minutes_90s", "defensive_actions_per_90")}
FROM panel WHERE minutes_90s >= 5.0""")
def rate_metrics_compat(spark, sf):
    enough = panel(spark, sf).where("minutes_90s >= 5.0")
    return metrics.add_rates_compat(enough, M.SCOUTING_RATES).select(*KEYS, *rounded(RATES))


@query("derived_ratios", f"""WITH {RATED_SQL}
SELECT player_id, squad, season_id, {rounded_sql(["goals_vs_xg", "npxg_per_shot", "aerial_win_pct"])} FROM rated""")
def derived_ratios(spark, sf):
    return rated(spark, sf).select(*KEYS, *rounded(["goals_vs_xg", "npxg_per_shot", "aerial_win_pct"]))


@query("peer_percentiles", f"""WITH {SCOUTING_SQL}
SELECT player_id, squad, season_id, primary_position, {rounded_sql(RATES + PERCENTILES)} FROM scouting""")
def peer_percentiles(spark, sf):
    return scouting(spark, sf).select(*KEYS, "primary_position", *rounded(RATES + PERCENTILES))


@query("peer_percentiles_split", f"""WITH {SCOUTING_SQL}
SELECT player_id, squad, season_id, primary_position, {rounded_sql(PERCENTILES)} FROM scouting""")
def peer_percentiles_split(spark, sf):
    """Ranks alone, without the rates."""
    return scouting(spark, sf).select(*KEYS, "primary_position", *rounded(PERCENTILES))


@query("specialist_percentiles", f"""WITH {PANEL_SQL}, {KEEPERS_SQL}
SELECT player_id, squad, season_id, is_u23_prospect,
  {rounded_sql(["psxg_plus_minus_per_90", "sweeper_actions_per_90"] + KEEPER_PERCENTILES)} FROM keepers""")
def specialist_percentiles(spark, sf):
    return keepers(spark, sf).select(*KEYS, "is_u23_prospect", *rounded(
        ["psxg_plus_minus_per_90", "sweeper_actions_per_90"] + KEEPER_PERCENTILES))


_TIE_SQL = """SELECT player_id, squad, season_id,
  round(CASE WHEN save_pct IS NOT NULL THEN
    (rank() OVER (PARTITION BY season_id ORDER BY save_pct NULLS LAST)
     + (count(*) OVER (PARTITION BY season_id, save_pct) - 1) / 2.0) / count(save_pct) OVER (PARTITION BY season_id)
    * 100 END, 9) + 0.0 AS save_percentile,
  round((rank() OVER (PARTITION BY season_id ORDER BY goals_against DESC NULLS LAST)
     + (count(*) OVER (PARTITION BY season_id, goals_against) - 1) / 2.0) / count(goals_against) OVER (PARTITION BY season_id)
    * 100, 9) + 0.0 AS conceded_percentile
FROM keeper_rated"""


def _tie_percentiles(spark, sf):
    rows = M.keeper_rates(materialize(keeper_panel(spark, sf), "keepers"))
    ranked = ranking.tie_percentiles(rows, ["season_id"],
                                     {"save": "save_pct", "conceded": "goals_against"}, ["goals_against"])
    return ranked.select(*KEYS, r9(F.col("save") * 100, "save_percentile"),
                         r9(F.col("conceded") * 100, "conceded_percentile"))


@query("tie_avg_percentile", f"WITH {PANEL_SQL}, {KEEPERS_SQL} {_TIE_SQL}")
def tie_avg_percentile(spark, sf):
    return _tie_percentiles(spark, sf)


@query("tie_avg_percentile_split", f"WITH {PANEL_SQL}, {KEEPERS_SQL} {_TIE_SQL}")
def tie_avg_percentile_split(spark, sf):
    return _tie_percentiles(spark, sf)


_KEEPER_KPIS = V.ROLE_KPIS["Goalkeeper"]["scoring"]
_KPI_PAIRS = [(role, m) for role, cfg in V.ROLE_KPIS.items() for m in cfg["scoring"]
              if m in PANEL_COLUMNS + RATES + _KEEPER_KPIS]
_KPI_VALUES = ", ".join(f"('{r}', '{m}')" for r, m in _KPI_PAIRS)
_KPI_METRICS = list(dict.fromkeys(m for _, m in _KPI_PAIRS))
SCORES_SQL = f"""{KEEPERS_SQL.strip()},
scorable AS (SELECT r.*, {", ".join(f"k.{m}" for m in _KEEPER_KPIS)} FROM rated r
  LEFT JOIN keeper_rated k USING (player_id, squad, season_id)),
kpi(role, metric) AS (VALUES {_KPI_VALUES}),
doubled AS (SELECT player_id, squad, season_id, scouting_role, {", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in _KPI_METRICS)} FROM scorable),
long AS (SELECT d.* FROM (UNPIVOT doubled ON {", ".join(_KPI_METRICS)} INTO NAME metric VALUE v) d
  JOIN kpi ON kpi.role = d.scouting_role AND kpi.metric = d.metric),
ranked AS (SELECT *, (rank() OVER (PARTITION BY season_id, scouting_role, metric ORDER BY v)
    + (count(*) OVER (PARTITION BY season_id, scouting_role, metric, v) - 1) / 2.0)
    / count(*) OVER (PARTITION BY season_id, scouting_role, metric) AS pct FROM long),
means AS (SELECT player_id, squad, season_id, avg(pct) * 100 AS s FROM ranked GROUP BY ALL),
scored AS (SELECT r.*, coalesce(s, 0.0) AS overall_score FROM rated r LEFT JOIN means USING (player_id, squad, season_id))"""


def scorable(spark, sf):
    """Rated rows with the measures that goalkeepers are scored by, from one pass over the lines."""
    field, specialists = both_rated(spark, sf)
    return join_same(field, specialists.select(*KEYS, *_KEEPER_KPIS), KEYS)


def scored(spark, sf):
    return metrics.role_scores(scorable(spark, sf), ["season_id"])


@query("composite_score", f"""WITH {RATED_SQL}, {SCORES_SQL}
SELECT player_id, squad, season_id, scouting_role, {q9("overall_score")} FROM scored""")
def composite_score(spark, sf):
    return scored(spark, sf).select(*KEYS, "scouting_role", r9("overall_score"))


@query("leaderboard", f"""WITH {RATED_SQL}, {SCORES_SQL}
SELECT player_name, squad, season_id, scouting_role, {q9("overall_score")} FROM scored
WHERE season_id = (SELECT max(season_id) FROM rated) AND scouting_role = 'Attacker'
ORDER BY round(overall_score, 9) DESC, player_id, squad LIMIT 10""")
def leaderboard(spark, sf):
    rows = rated(spark, sf)
    newest = panel(spark, sf).where("minutes_90s >= 5").agg(F.max("season_id")).scalar()
    current = rows.where((F.col("season_id") == newest) & (F.col("scouting_role") == "Attacker"))
    board = metrics.role_scores(current, ["season_id"]).withColumn("overall_score", F.round("overall_score", 9))
    return metrics.leaderboard(board, "overall_score", 10, ["player_id", "squad"]).select(
        "player_name", "squad", "season_id", "scouting_role", r9("overall_score"))


def _quadrant_sql(lines):
    return f"""WITH {RATED_SQL}, ref_lines AS (SELECT season_id, scouting_role, {lines} FROM rated GROUP BY ALL)
SELECT player_id, squad, season_id, scouting_role, {q9("x_line")}, {q9("y_line")},
  CASE WHEN expected_contribution_per_90 >= x_line AND goal_contribution_per_90 >= y_line THEN 'Elite'
       WHEN expected_contribution_per_90 >= x_line THEN 'Specialist'
       WHEN goal_contribution_per_90 >= y_line THEN 'Efficient' ELSE 'Developing' END AS quadrant
FROM rated JOIN ref_lines USING (season_id, scouting_role)"""


def _quadrants(spark, sf, baseline):
    out = metrics.quadrants(stored_rated(spark, sf), ["season_id", "scouting_role"], "expected_contribution_per_90",
                            "goal_contribution_per_90", baseline)
    return out.select(*KEYS, "scouting_role", r9("x_line"), r9("y_line"), "quadrant")


@query("quadrants", _quadrant_sql("avg(expected_contribution_per_90) AS x_line, avg(goal_contribution_per_90) AS y_line"))
def quadrants(spark, sf):
    return _quadrants(spark, sf, "mean")


@query("quadrants_median",
       _quadrant_sql("median(expected_contribution_per_90) AS x_line, median(goal_contribution_per_90) AS y_line"))
def quadrants_median(spark, sf):
    return _quadrants(spark, sf, "median")


_AXIS = "CASE scouting_role " + " ".join(
    f"WHEN '{r}' THEN CAST({{{r}}} AS DOUBLE)" for r in V.ROLE_KPIS if r != "Goalkeeper") + " END"


def _axis_sql(axis):
    return _AXIS.format(**{r: cfg[axis] for r, cfg in V.ROLE_KPIS.items()})


@query("role_quadrants", f"""WITH {RATED_SQL},
axes AS (SELECT *, {_axis_sql("x")} AS kpi_x, {_axis_sql("y")} AS kpi_y, {_axis_sql("size")} AS kpi_size FROM rated),
ref_lines AS (SELECT season_id, scouting_role, avg(kpi_x) AS x_line, avg(kpi_y) AS y_line FROM axes GROUP BY ALL)
SELECT player_id, squad, season_id, scouting_role, {q9("kpi_x")}, {q9("kpi_y")}, {q9("kpi_size")},
  CASE WHEN kpi_x >= x_line AND kpi_y >= y_line THEN 'Elite' WHEN kpi_x >= x_line AND kpi_y < y_line THEN 'Specialist'
       WHEN kpi_x < x_line AND kpi_y >= y_line THEN 'Efficient' WHEN kpi_x < x_line AND kpi_y < y_line THEN 'Developing' END AS quadrant
FROM axes JOIN ref_lines USING (season_id, scouting_role)""")
def role_quadrants(spark, sf):
    charted = metrics.role_axes(stored_rated(spark, sf))
    out = metrics.quadrants(charted, ["season_id", "scouting_role"], "kpi_x", "kpi_y")
    return out.select(*KEYS, "scouting_role", r9("kpi_x"), r9("kpi_y"), r9("kpi_size"), "quadrant")


@query("squad_score", f"""WITH {RATED_SQL}, {SCORES_SQL}, squad_means AS (
  SELECT season_id, primary_position, squad, avg(overall_score) AS squad_score FROM scored GROUP BY ALL)
SELECT season_id, primary_position, squad, {q9("squad_score")} FROM squad_means""")
def squad_score(spark, sf):
    means = metrics.group_mean(scored(spark, sf), ["season_id", "primary_position", "squad"], "overall_score", "squad_score")
    return means.select("season_id", "primary_position", "squad", r9("squad_score"))


_DIST = ["n", "min_value", "max_value", "mean_value", "q1", "median", "q3"]
_DIST_SQL = f"""WITH {RATED_SQL}, dist AS (SELECT competition, count(defensive_actions_per_90) AS n,
  min(defensive_actions_per_90) AS min_value, max(defensive_actions_per_90) AS max_value,
  avg(defensive_actions_per_90) AS mean_value, quantile_cont(defensive_actions_per_90, 0.25) AS q1,
  median(defensive_actions_per_90) AS median, quantile_cont(defensive_actions_per_90, 0.75) AS q3
  FROM rated GROUP BY competition)
SELECT competition, n, {rounded_sql(_DIST[1:])} FROM dist"""


@query("group_distribution", _DIST_SQL)
def group_distribution(spark, sf):
    out = metrics.group_distribution(rated(spark, sf), ["competition"], "defensive_actions_per_90")
    return out.select("competition", "n", *rounded(_DIST[1:]))


@query("group_distribution_split", _DIST_SQL)
def group_distribution_split(spark, sf):
    out = metrics.group_distribution(rated(spark, sf), ["competition"], "defensive_actions_per_90")
    return out.select("competition", "n", *rounded(_DIST[1:]))


# --- marts --------------------------------------------------------------------

_INDEX = """CASE WHEN primary_position IN ('MF', 'MF,DF') THEN progression_total_dist_per_90
  WHEN primary_position IN ('DF', 'DF,MF') THEN defensive_actions_per_90
  WHEN primary_position = 'GK' THEN gk_metric ELSE expected_contribution_per_90 END"""
TRENDS_SQL = f"""{RATED_SQL}, {KEEPERS_SQL},
combined AS (
  SELECT player_id, player_name, season_id, squad, age, primary_position, minutes_90s, CAST(goals AS DOUBLE) AS goals,
    npxg, expected_contribution_per_90, progression_total_dist_per_90, defensive_actions_per_90, 0.0::DOUBLE AS gk_metric
  FROM rated WHERE primary_position <> 'GK'
  UNION ALL
  SELECT player_id, player_name, season_id, squad, age, 'GK', minutes_90s, 0.0, 0.0, 0.0, 0.0, 0.0, psxg_plus_minus_per_90
  FROM keeper_rated),
indexed AS (SELECT *, {_INDEX} AS specialist_index, expected_contribution_per_90 AS scoring_index FROM combined),
trends AS (SELECT player_id, player_name, season_id, squad, primary_position, age, specialist_index, scoring_index, goals, npxg,
    specialist_index - lag(specialist_index) OVER h AS yoy_change_specialist,
    scoring_index - lag(scoring_index) OVER h AS yoy_change_scoring
  FROM indexed WINDOW h AS (PARTITION BY player_id ORDER BY season_id, squad))"""


def both_rated(spark, sf):
    field, specialists = both_panels(spark, sf)
    return M.scouting_rates(field), M.keeper_rates(specialists)


def trends(spark, sf):
    return M.trends_mart(*both_rated(spark, sf))


@query("role_union", f"""WITH {TRENDS_SQL}
SELECT player_id, squad, season_id, primary_position, {rounded_sql(["goals", "npxg", "gk_metric"])} FROM combined""")
def role_union(spark, sf):
    rows = M.combined_roles(*both_rated(spark, sf))
    return rows.select(*KEYS, "primary_position", *rounded(["goals", "npxg", "gk_metric"]))


@query("specialist_index", f"""WITH {TRENDS_SQL}
SELECT player_id, squad, season_id, primary_position, {rounded_sql(["specialist_index", "scoring_index"])} FROM indexed""")
def specialist_index_query(spark, sf):
    rows = M.combined_roles(*both_rated(spark, sf))
    return rows.select(*KEYS, "primary_position", *rounded(["specialist_index", "scoring_index"]))


@query("yoy_change", f"""WITH {PANEL_SQL}
SELECT player_id, squad, season_id, goals, goals - lag(goals) OVER h AS goals_change,
  {q9("npxg - lag(npxg) OVER h", "npxg_change")}
FROM panel WINDOW h AS (PARTITION BY player_id ORDER BY season_id, squad)""")
def yoy_change(spark, sf):
    changed = P.period_change(panel(spark, sf), "player_id", ["season_id", "squad"],
                              {"goals_change": "goals", "npxg_change": "npxg"})
    return changed.select(*KEYS, "goals", "goals_change", r9("npxg_change"))


_TREND_VALUES = ["specialist_index", "scoring_index", "goals", "npxg", "yoy_change_specialist", "yoy_change_scoring"]


@query("entity_trends", f"""WITH {TRENDS_SQL}
SELECT player_id, player_name, season_id, squad, primary_position, age, {rounded_sql(_TREND_VALUES)} FROM trends""")
def entity_trends(spark, sf):
    return trends(spark, sf).select("player_id", "player_name", "season_id", "squad", "primary_position", "age",
                                    *rounded(_TREND_VALUES))


@query("entity_trend_rows", f"""WITH {TRENDS_SQL}
SELECT player_name, season_id, squad, primary_position, {rounded_sql(_TREND_VALUES)} FROM trends
WHERE player_name = (SELECT min(player_name) FROM trends) ORDER BY season_id, squad""")
def entity_trend_rows(spark, sf):
    """Trend rows of one name, oldest season first."""
    rows = materialize(trends(spark, sf), "trends")
    name = rows.agg(F.min("player_name")).scalar()
    columns = ["player_name", "season_id", "squad", "primary_position", *_TREND_VALUES]
    own = P.entity_history(F.col("player_name") == name, rows, rows.where("false"), columns)
    return own.select(*columns[:4], *rounded(_TREND_VALUES))


# Thresholds at the scale of these tables.
VOLATILITY, FORM = 0.5, -0.2
_CONSISTENCY_VALUES = ["performance_volatility", "career_peak_performance", "form_vs_avg"]
CONSISTENCY_SQL = f"""{TRENDS_SQL},
volatility AS (SELECT player_id, player_name, primary_position, count(DISTINCT season_id) AS seasons_tracked,
    stddev_samp(specialist_index) AS performance_volatility, max(specialist_index) AS career_peak_performance,
    arg_max(specialist_index, (season_id, squad)) - avg(specialist_index) AS form_vs_avg
  FROM trends GROUP BY 1, 2, 3),
consistency AS (SELECT *, CASE WHEN seasons_tracked < 2 THEN '{V.RISK_NEW}'
    WHEN performance_volatility > {VOLATILITY} THEN '{V.RISK_HIGH}'
    WHEN form_vs_avg < {FORM} THEN '{V.RISK_DECLINING}' ELSE '{V.RISK_SAFE}' END AS transfer_risk_rating FROM volatility)"""


@query("consistency", f"""WITH {CONSISTENCY_SQL}
SELECT player_id, player_name, primary_position, seasons_tracked, {rounded_sql(_CONSISTENCY_VALUES)}, transfer_risk_rating
FROM consistency""")
def consistency(spark, sf):
    out = M.consistency_mart(trends(spark, sf), VOLATILITY, FORM)
    return out.select("player_id", "player_name", "primary_position", "seasons_tracked",
                      *rounded(_CONSISTENCY_VALUES), "transfer_risk_rating")


_SQUAD_VALUES = ["avg_age", "starter_avg_xg_xag", "starter_avg_progression", "starter_avg_def_actions"]


@query("squad_profile", f"""WITH {RATED_SQL}, profile AS (
  SELECT squad, season_id, competition, primary_position, count(DISTINCT player_id) AS depth_count, avg(age) AS avg_age,
    avg(CASE WHEN minutes_90s > 8 THEN expected_contribution_per_90 END) AS starter_avg_xg_xag,
    avg(CASE WHEN minutes_90s > 8 THEN progression_total_dist_per_90 END) AS starter_avg_progression,
    avg(CASE WHEN minutes_90s > 8 THEN defensive_actions_per_90 END) AS starter_avg_def_actions
  FROM rated GROUP BY 1, 2, 3, 4)
SELECT squad, season_id, competition, primary_position, depth_count, {rounded_sql(_SQUAD_VALUES)} FROM profile""")
def squad_profile(spark, sf):
    out = M.squad_profile_mart(rated(spark, sf), starter_exposure=8.0)
    return out.select("squad", "season_id", "competition", "primary_position", "depth_count", *rounded(_SQUAD_VALUES))


VALUATION_SQL = f"""{SCOUTING_SQL},
valuation AS (SELECT player_id, player_name, season_id, squad, age,
  CASE WHEN percentile_attacking > 0.90 OR percentile_defense > 0.90 THEN '{V.TIER_S}'
       WHEN percentile_attacking > 0.75 OR percentile_defense > 0.75 THEN '{V.TIER_A}'
       WHEN percentile_attacking > 0.50 THEN '{V.TIER_B}' ELSE '{V.TIER_C}' END AS performance_tier,
  (expected_contribution_per_90 * 50 + defensive_actions_per_90 * 5)
    * CASE WHEN age < 23 THEN 1.5::DOUBLE WHEN age > 30 THEN 0.5 ELSE 1.0 END
    * CASE WHEN competition LIKE '%Premier League' THEN 2.0::DOUBLE WHEN competition LIKE '%La Liga' THEN 1.5
           WHEN competition LIKE '%Bundesliga' THEN 1.5 WHEN competition LIKE '%Serie A' THEN 1.2 ELSE 1.0 END
    AS exact_value,
  CASE WHEN minutes_90s < 10 THEN 'Fringe' ELSE 'Key Player' END AS squad_status FROM scouting),
valued AS (SELECT * EXCLUDE (exact_value), round(exact_value, 1) AS market_value_est_m_eur FROM valuation)"""


@query("valuation", f"""WITH {VALUATION_SQL}
SELECT player_id, player_name, season_id, squad, age, performance_tier, market_value_est_m_eur, squad_status FROM valued""")
def valuation(spark, sf):
    return M.valuation_mart(scouting(spark, sf))


@query("undervalued", f"""WITH {VALUATION_SQL}
SELECT player_name, squad, season_id, performance_tier, market_value_est_m_eur FROM valued
WHERE performance_tier IN ('{V.TIER_S}', '{V.TIER_A}') AND market_value_est_m_eur < 30
ORDER BY market_value_est_m_eur, player_id, squad, season_id LIMIT 10""")
def undervalued(spark, sf):
    cheap = metrics.undervalued(M.valuation_mart(scouting(spark, sf)), tie_break=["player_id", "squad", "season_id"])
    return cheap.select("player_name", "squad", "season_id", "performance_tier", "market_value_est_m_eur")


@query("serving_join", f"""WITH {CONSISTENCY_SQL.replace(RATED_SQL, VALUATION_SQL, 1)}
SELECT s.player_id, s.squad, s.season_id, market_value_est_m_eur, performance_tier, squad_status, transfer_risk_rating,
  {q9("performance_volatility")}
FROM scouting s LEFT JOIN valued v ON s.player_id = v.player_id AND s.squad = v.squad AND s.season_id = v.season_id
LEFT JOIN consistency c ON s.player_id = c.player_id AND s.primary_position = c.primary_position""")
def serving_join(spark, sf):
    field, specialists = both_panels(spark, sf)
    scouted = materialize(M.scouting_mart(field), "scouting")
    risk = M.consistency_mart(M.trends_mart(scouted, M.keeper_rates(specialists)), VOLATILITY, FORM)
    out = P.serving_join(scouted, M.valuation_mart(scouted), risk)
    return out.select(*KEYS, "market_value_est_m_eur", "performance_tier", "squad_status", "transfer_risk_rating",
                      r9("performance_volatility"))


# --- one entity against its peers -----------------------------------------------

_BEST = "season_id DESC, expected_contribution_per_90 DESC, player_id, squad"


def _pick(rows: DataFrame, place: int) -> DataFrame:
    """Best or second best outfield row of the newest season."""
    order = [F.desc("season_id"), F.desc("expected_contribution_per_90"), F.asc("player_id"), F.asc("squad")]
    best = rows.where("primary_position <> 'GK'").orderBy(*order).limit(place)
    reverse = [F.asc("season_id"), F.asc("expected_contribution_per_90"), F.desc("player_id"), F.desc("squad")]
    return best.orderBy(*reverse).limit(1)


_MENU = [(i, cat, c, label) for i, (cat, c, label) in enumerate(V.OUTFIELD_MENU, 1) if c in PANEL_COLUMNS + RATES]


_KEEPER_MENU = [(i, *entry) for i, entry in enumerate(V.KEEPER_MENU, 1)]


def _best_keeper(rows: DataFrame) -> DataFrame:
    order = [F.desc("season_id"), F.desc("psxg_plus_minus_per_90"), F.asc("player_id"), F.asc("squad")]
    return rows.orderBy(*order).limit(1)


def _row_sql(name: str, place: int, source: str = "rated") -> str:
    best = _BEST if source == "rated" else _BEST.replace("expected_contribution_per_90", "psxg_plus_minus_per_90")
    outfield = "WHERE primary_position <> 'GK' " if source == "rated" else ""
    return f"{name}_row AS (SELECT * FROM {source} {outfield}ORDER BY {best} LIMIT 1 OFFSET {place - 1})"


def _profile_sql(name: str, place: int, source: str = "rated", keys: str = "season_id, primary_position", menu=_MENU) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {i} AS menu_position, '{cat}' AS category, '{label}' AS metric, "
        f"(count(*) FILTER (WHERE p.{c} {'>' if c in V.LOWER_IS_BETTER else '<'} t.{c}) "
        f"+ (count(*) FILTER (WHERE p.{c} = t.{c}) + 1) / 2.0) / count(p.{c}) * 100 AS percentile, "
        f"CAST(max(t.{c}) AS DOUBLE) AS raw FROM {source} p JOIN {name}_row t USING ({keys})"
        for i, cat, c, label in menu)
    return f"""{_row_sql(name, place, source)},
{name} AS ({parts})"""


_PROFILE_1, _PROFILE_2 = _profile_sql("first_p", 1), _profile_sql("second_p", 2)


def _profiles(spark, sf, places=(1, 2)):
    rows = materialize(rated(spark, sf), "rated")
    return [compare.metric_profile(rows, _pick(rows, p), V.OUTFIELD_MENU) for p in places]


@query("metric_profile", f"""WITH {RATED_SQL}, {_PROFILE_1}
SELECT menu_position, category, metric, {q9("percentile")}, {q9("raw")} FROM first_p""")
def metric_profile(spark, sf):
    return _profiles(spark, sf, (1,))[0].select("menu_position", "category", "metric", r9("percentile"), r9("raw"))


_CARDS = V.OUTFIELD_CARDS


def _card_sql(card):
    section, label, column, pattern, unit = card
    if column not in PANEL_COLUMNS + KEEPER_COLUMNS + ["goals_vs_xg", "npxg_per_shot", "aerial_win_pct",
                                                       "psxg_plus_minus_per_90", "sweeper_actions_per_90"]:
        shown = "'-'"
    else:
        exact = f"round(CAST({column} AS DECIMAL(18,6)), {pattern[2]})"
        shown = f"coalesce(printf('{pattern}', CAST({exact} AS DOUBLE)) || '{unit}', '-')"
    return f"{{'section': '{section}', 'label': '{label}', 'shown': {shown}}}"


@query("keeper_profile", f"""WITH {PANEL_SQL}, {KEEPERS_SQL}, {_profile_sql("first_k", 1, "keeper_rated", "season_id", _KEEPER_MENU)}
SELECT menu_position, category, metric, {q9("percentile")}, {q9("raw")} FROM first_k""")
def keeper_profile(spark, sf):
    """Goalkeepers by their own menu among the goalkeepers of the season; few goals conceded are good."""
    rows = materialize(rated_keepers(spark, sf), "rated")
    profile = compare.metric_profile(rows, _best_keeper(rows), V.KEEPER_MENU, ["season_id"])
    return profile.select("menu_position", "category", "metric", r9("percentile"), r9("raw"))


@query("keeper_cards", f"""WITH {PANEL_SQL}, {KEEPERS_SQL}, cards AS (
  SELECT player_id, squad, season_id, unnest([{", ".join(_card_sql(c) for c in V.KEEPER_CARDS)}]) AS e FROM keeper_rated)
SELECT player_id, squad, season_id, e.section AS section, e.label AS label, e.shown AS shown FROM cards""")
def keeper_cards(spark, sf):
    return compare.season_breakdown(rated_keepers(spark, sf), KEYS, V.KEEPER_CARDS)


@query("strengths_weaknesses", f"""WITH {RATED_SQL}, {_PROFILE_1},
sides AS (SELECT 'strength' AS side, * FROM first_p WHERE percentile >= 75
  UNION ALL SELECT 'weakness', * FROM first_p WHERE percentile <= 25),
numbered AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY menu_position) AS n FROM sides)
SELECT side, menu_position, metric, {q9("percentile")} FROM numbered WHERE n <= 5""")
def strengths_weaknesses(spark, sf):
    notes = compare.strengths_weaknesses(_profiles(spark, sf, (1,))[0])
    return notes.select("side", "menu_position", "metric", r9("percentile"))


@query("head_to_head", f"""WITH {RATED_SQL}, {_PROFILE_1}, {_PROFILE_2},
diffs AS (SELECT a.category, a.metric, a.menu_position, a.percentile - b.percentile AS diff
  FROM first_p a JOIN second_p b USING (category, metric)),
sides AS (SELECT 'first' AS better, *, row_number() OVER (ORDER BY diff DESC, menu_position) AS n FROM diffs WHERE diff > 15
  UNION ALL SELECT 'second', *, row_number() OVER (ORDER BY diff, menu_position) FROM diffs WHERE diff < -15)
SELECT better, category, metric, {q9("diff")} FROM sides WHERE n <= 3""")
def head_to_head(spark, sf):
    first, second = _profiles(spark, sf)
    return compare.head_to_head(first, second).select("better", "category", "metric", r9("diff"))


@query("comparison_table", f"""WITH {RATED_SQL}, {_PROFILE_1}, {_PROFILE_2}
SELECT a.category, a.metric, a.menu_position,
  printf('%.2f (%d%%)', a.raw, CAST(floor(a.percentile) AS INT)) AS "first",
  printf('%.2f (%d%%)', b.raw, CAST(floor(b.percentile) AS INT)) AS "second",
  {q9("a.raw", "raw_p1")}, {q9("b.raw", "raw_p2")}
FROM first_p a JOIN second_p b USING (category, metric) ORDER BY 1, 3""")
def comparison_table(spark, sf):
    first, second = _profiles(spark, sf)
    return compare.comparison_table(first, second).select(
        "category", "metric", "menu_position", "first", "second", r9("raw_p1"), r9("raw_p2"))


_STYLE = ["goals", "assists", "npxg", "xag", "shots_total", "key_passes", "tackles_won", "interceptions",
          "expected_contribution_per_90", "defensive_actions_per_90"]


@query("zscore_features", f"""WITH {RATED_SQL}
SELECT player_id, squad, season_id, {", ".join(
    f'''round((CAST({f} AS DOUBLE) - avg({f}) OVER w) / nullif(stddev_samp({f}) OVER w, 0), 9) + 0.0 AS z_{f}'''
    for f in _STYLE)}
FROM rated WINDOW w AS (PARTITION BY season_id, primary_position)""")
def zscore_features(spark, sf):
    out = similarity.zscores(stored_rated(spark, sf), ["season_id", "primary_position"], _STYLE)
    return out.select(*KEYS, *rounded([f"z_{f}" for f in _STYLE]))


_GAPS = " + ".join(f"coalesce(pow((p.{f} - t.{f}) / nullif(s.sd_{f}, 0), 2), 0)" for f in _STYLE)


@query("similar_entities", f"""WITH {RATED_SQL}, {_row_sql("first_p", 1)},
peers AS (SELECT p.* FROM rated p JOIN first_p_row t USING (season_id, primary_position)),
stats AS (SELECT count(*) AS n, {", ".join(f"stddev_samp({f}) AS sd_{f}" for f in _STYLE)} FROM peers),
near AS (SELECT p.player_id, p.player_name, p.squad, p.age, p.nation, sqrt({_GAPS}) AS distance
  FROM peers p, first_p_row t, stats s WHERE p.player_id <> t.player_id AND s.n > 5)
SELECT player_id, player_name, squad, age, nation, {q9("distance")}, {q9("1 / (1 + distance)", "similarity")}
FROM near ORDER BY round(distance, 9), player_id, squad LIMIT 5""")
def similar_entities(spark, sf):
    rows = materialize(rated(spark, sf), "rated")
    near = similarity.similar_entities(rows, _pick(rows, 1), _STYLE)
    return near.select("player_id", "player_name", "squad", "age", "nation", r9("distance"), r9("similarity"))


@query("knn_vectors", """WITH target AS (SELECT * FROM embeddings ORDER BY vec_id LIMIT 1),
near AS (SELECT e.vec_id, e.label,
    sqrt(list_sum(list_transform(list_zip(e.embedding, t.embedding), lambda z: pow(CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE), 2)))) AS distance
  FROM embeddings e JOIN target t ON e.label = t.label AND e.vec_id <> t.vec_id)
SELECT vec_id, label, round(distance, 9) + 0.0 AS distance, round(1 / (1 + distance), 9) + 0.0 AS similarity
FROM near ORDER BY near.distance, vec_id LIMIT 5""")
def knn_vectors(spark, sf):
    vectors = table(spark, sf, "embeddings")
    target = vectors.orderBy("vec_id").limit(1)
    near = similarity.nearest_vectors(vectors, target, "embedding", "vec_id", ["label"])
    return near.select("vec_id", "label", r9("distance"), r9("similarity"))


# --- rows of one entity, facets, labels ------------------------------------------

@query("latest_row", f"""WITH {PANEL_SQL}
SELECT player_id, squad, season_id, goals, {q9("npxg")} FROM panel
QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY season_id DESC, squad DESC) = 1""")
def latest_row(spark, sf):
    return shape.latest_row(panel(spark, sf), ["player_id"], "season_id", "squad").select(
        *KEYS, "goals", r9("npxg"))


_HISTORY = ["player_name", "season_id", "squad", "primary_position", "minutes_90s", "save_pct", "npxg"]


@query("entity_history", f"""WITH {RATED_SQL}, {KEEPERS_SQL},
chosen AS (SELECT min(player_name) AS player_name FROM keeper_rated),
kept AS (SELECT player_name, season_id, squad, primary_position, minutes_90s, save_pct, CAST(NULL AS DOUBLE) AS npxg
  FROM keeper_rated JOIN chosen USING (player_name)),
field AS (SELECT player_name, season_id, squad, primary_position, minutes_90s, CAST(NULL AS DOUBLE) AS save_pct, npxg
  FROM rated JOIN chosen USING (player_name) WHERE NOT EXISTS (SELECT 1 FROM kept)),
both_sides AS (SELECT * FROM kept UNION ALL SELECT * FROM field)
SELECT player_name, season_id, squad, primary_position, minutes_90s, {q9("save_pct")}, {q9("npxg")}
FROM both_sides ORDER BY season_id, squad""")
def entity_history(spark, sf):
    field, specialists = both_rated(spark, sf)
    name = specialists.agg(F.min("player_name")).scalar()
    rows = P.entity_history(F.col("player_name") == name, specialists, field, _HISTORY)
    return rows.select(*_HISTORY[:5], r9("save_pct"), r9("npxg"))


@query("season_breakdown", f"""WITH {RATED_SQL}, cards AS (
  SELECT player_id, squad, season_id, unnest([{", ".join(_card_sql(c) for c in _CARDS)}]) AS e FROM rated)
SELECT player_id, squad, season_id, e.section AS section, e.label AS label, e.shown AS shown FROM cards""")
def season_breakdown(spark, sf):
    return compare.season_breakdown(rated(spark, sf), KEYS, _CARDS)


@query("entity_history_fallback", f"""WITH {RATED_SQL}
SELECT player_name, season_id, squad, primary_position, minutes_90s, CAST(NULL AS DOUBLE) AS save_pct, {q9("npxg")} FROM rated
WHERE player_name = (SELECT min(player_name) FROM rated WHERE primary_position <> 'GK') ORDER BY season_id, squad""")
def entity_history_fallback(spark, sf):
    """A name that the preferred table does not hold: rows come from the other one."""
    field, specialists = both_rated(spark, sf)
    name = field.where("primary_position <> 'GK'").agg(F.min("player_name")).scalar()
    rows = P.entity_history(F.col("player_name") == name, specialists, field, _HISTORY)
    return rows.select(*_HISTORY[:5], r9("save_pct"), r9("npxg"))


@query("facet_filter", f"""WITH {RATED_SQL}
SELECT player_id, squad, season_id, competition, age FROM rated
WHERE season_id IN ('1998', '1999') AND competition IN ('eng Premier League', 'it Serie A')
  AND age BETWEEN 18 AND 30 AND is_u23_prospect AND scouting_role = 'Midfielder'""")
def facet_filter(spark, sf):
    rows = P.facet_filter(rated(spark, sf), ["1998", "1999"], ["eng Premier League", "it Serie A"], None, (18, 30), True,
                          "Midfielder")
    return rows.select(*KEYS, "competition", "age")


@query("facet_values", f"""WITH {PANEL_SQL},
seasons AS (SELECT DISTINCT season_id AS v FROM panel), leagues AS (SELECT DISTINCT competition AS v FROM panel),
squads AS (SELECT DISTINCT squad AS v FROM panel WHERE competition IN ('es La Liga'))
SELECT 'season' AS facet, v AS value FROM seasons UNION ALL SELECT 'league', v FROM leagues UNION ALL SELECT 'squad', v FROM squads
UNION ALL SELECT 'min_age', CAST(coalesce(min(age), 15) AS VARCHAR) FROM panel
UNION ALL SELECT 'max_age', CAST(coalesce(max(age), 45) AS VARCHAR) FROM panel""")
def facet_values(spark, sf):
    return P.facet_values(stored_panel(spark, sf).select("season_id", "competition", "squad", "age"), ["es La Liga"])


@query("cohort_flag", f"""WITH {PERSONS_SQL}
SELECT player_id, birth_year, coalesce((2026 - birth_year) <= 23, false) AS is_u23_prospect,
  coalesce((2020 - nullif(birth_year, 2000)) <= 21, false) AS young_in_2020 FROM persons""")
def cohort_flag_query(spark, sf):
    born = F.col("birth_year")
    return persons(spark, sf).select("player_id", "birth_year", cohort_flag(born).alias("is_u23_prospect"),
                                     cohort_flag(F.nullif(born, F.lit(2000)), 2020, 21).alias("young_in_2020"))


@query("role_map", f"""WITH {PERSONS_SQL}
SELECT player_id, primary_position, {ROLE_SQL} AS scouting_role FROM persons""")
def role_map(spark, sf):
    return persons(spark, sf).select("player_id", "primary_position",
                                     role_of(F.col("primary_position")).alias("scouting_role"))


@query("squad_status", f"""WITH {PANEL_SQL}
SELECT squad, season_id, CASE WHEN minutes_90s < 10 THEN 'Fringe' ELSE 'Key Player' END AS squad_status, count(*) AS n
FROM panel GROUP BY ALL""")
def squad_status_query(spark, sf):
    status = squad_status(F.col("minutes_90s")).alias("squad_status")
    return panel(spark, sf).groupBy("squad", "season_id", status).agg(F.count(F.lit(1)).alias("n"))


# Three-letter codes that occur in the tables and are ISO codes: (code, name, two-letter code).
_ISO = [("ARG", "Argentina", "ar"), ("BRA", "Brazil", "br"), ("CAN", "Canada", "ca"), ("EGY", "Egypt", "eg"),
        ("ETH", "Ethiopia", "et"), ("FRA", "France", "fr"), ("IND", "India", "in"), ("JOR", "Jordan", "jo"),
        ("KEN", "Kenya", "ke"), ("MOZ", "Mozambique", "mz"), ("PER", "Peru", "pe"), ("SAU", "Saudi Arabia", "sa"),
        ("RUS", "Russia", "ru")]
_NATION_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in [*V.NATION_NAMES.items(), *[r[:2] for r in _ISO]])
_FLAG_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in [*V.NATION_FLAG_CODES.items(), *[(r[0], r[2]) for r in _ISO]])
_CODED_SQL = """coded AS (SELECT player_id, nation, CASE WHEN regexp_full_match(split_part(nation, ' ', -1), '[A-Z]{3}')
  AND nation LIKE '% %' THEN split_part(nation, ' ', -1) ELSE nation END AS code FROM persons)"""


@query("nation_lookup", f"""WITH {PERSONS_SQL}, named(code, name) AS (VALUES {_NATION_VALUES}), {_CODED_SQL}
SELECT player_id, nation, coded.code AS nation_code, coalesce(name, coded.code) AS display_nation
FROM coded LEFT JOIN named ON named.code = coded.code""")
def nation_lookup(spark, sf):
    return display_nation(persons(spark, sf).select("player_id", "nation"), iso_countries(spark))


@query("flag_code", f"""WITH {PERSONS_SQL}, flags(code, flag) AS (VALUES {_FLAG_VALUES}), {_CODED_SQL}
SELECT player_id, nation, flag AS flag_code FROM coded LEFT JOIN flags ON flags.code = coded.code""")
def flag_code_query(spark, sf):
    return flag_code(persons(spark, sf).select("player_id", "nation"), iso_countries(spark))


# --- storage ------------------------------------------------------------------------

@query("mart_roundtrip", f"""WITH {PANEL_SQL}
SELECT player_id, squad, season_id, goals, {q9("npxg")} FROM panel""")
def mart_roundtrip(spark, sf):
    stored = save_mart(panel(spark, sf), new_path(spark, "mart"), ["season_id"])
    return stored.select(*KEYS, "goals", r9("npxg"))


@query("refresh_period", f"""WITH {PANEL_SQL}
SELECT player_id, squad, season_id, CASE WHEN season_id = (SELECT max(season_id) FROM panel) THEN goals * 2 ELSE goals END AS goals
FROM panel WHERE season_id <> (SELECT min(season_id) FROM panel)""")
def refresh_period_query(spark, sf):
    """The newest season is replaced, the oldest one has lost its rows and is emptied, all others stay."""
    path = new_path(spark, "mart")
    rows = save_mart(panel(spark, sf).select(*KEYS, "goals"), path, ["season_id"])
    first, last = rows.agg(F.min("season_id"), F.max("season_id")).first()
    changed = rows.where(F.col("season_id") == last).withColumn("goals", F.col("goals") * 2)
    periods = [p for p in (first, last) if p is not None]
    return refresh_period(materialize(changed.select(*KEYS, "goals"), "changed"), path, periods=periods).select(*KEYS, "goals")


@query("stamp_load", f"""WITH {PANEL_SQL}
SELECT player_id, squad, season_id, goals, true AS stamped FROM panel""")
def stamp_load_query(spark, sf):
    """The stamp is known and not before the start of the run."""
    begun = F.lit(datetime.now(timezone.utc)) - F.expr("INTERVAL 1 SECOND")
    stamped = stamp_load(panel(spark, sf).select(*KEYS, "goals"))
    known = F.coalesce(F.col("processed_at") >= begun, F.lit(False))
    return stamped.select(*KEYS, "goals", known.alias("stamped"))
