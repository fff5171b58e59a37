"""The given order tables read as a panel.

entity = customer, group = order priority, period = order year, exposure = number of lines.
Measures are sums over lines; discounts and taxes are summed as whole hundredths, so no sum
depends on the order of addition. The fragments below are plain SQL that both engines understand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize, new_path, scratch, stored
from .registry import table


def _lines_where(condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)"


LINE_MEASURES = {
    "n_lines": "count(*)",
    "minutes_played": "sum(CAST(l_quantity AS BIGINT))",
    "goals": _lines_where("l_returnflag = 'R'"),
    "assists": _lines_where("l_discount >= 0.05"),
    "npxg_sum": "sum(CAST(floor(l_discount * 100 + 0.5) AS BIGINT))",
    "xag_sum": "sum(CAST(floor(l_tax * 100 + 0.5) AS BIGINT))",
    "shots_total": _lines_where("l_quantity > 25"),
    "shots_on_target": _lines_where("l_quantity > 40"),
    "sca": _lines_where("l_linenumber = 1"),
    "gca": _lines_where("l_linenumber = 2"),
    "key_passes": _lines_where("l_linestatus = 'O'"),
    "pass_progressive_distance": "sum(CAST(l_quantity AS BIGINT))",
    "carry_progressive_distance": "sum(CAST(floor(l_extendedprice / 100) AS BIGINT))",
    "through_balls": _lines_where("l_linenumber = 3"),
    "switches": _lines_where("l_linenumber = 4"),
    "crosses": _lines_where("l_linenumber = 5"),
    "takeons_won": _lines_where("l_returnflag = 'A'"),
    "tackles_won": _lines_where("l_tax >= 0.04"),
    "interceptions": _lines_where("l_discount < 0.02"),
    "tackles_att_3rd": _lines_where("l_tax < 0.01"),
    "recoveries": _lines_where("l_returnflag = 'N'"),
    "aerials_won": _lines_where("l_linenumber >= 6"),
    "aerials_lost": _lines_where("l_linenumber = 7"),
    "touches": _lines_where("l_quantity < 30"),
    "touches_att_pen": _lines_where("l_quantity > 45"),
    "passes_completed": _lines_where("l_extendedprice > 30000"),
    "progressive_passes": _lines_where("l_extendedprice > 50000"),
    "passes_into_penalty_area": _lines_where("l_partkey % 7 = 0"),
    "progressive_carries": _lines_where("l_suppkey % 5 = 0"),
}
COUNTS = [m for m in LINE_MEASURES if m not in ("n_lines", "npxg_sum", "xag_sum")]

PERSON = {
    "player_name": "c_name",
    "birth_year": "CAST(1980 + c_custkey % 25 AS INT)",
    "age": "CAST(18 + c_custkey % 20 AS INT)",
    "primary_position": "CASE c_custkey % 6 WHEN 0 THEN 'FW' WHEN 1 THEN 'MF' WHEN 2 THEN 'DF' WHEN 3 THEN 'GK' "
                        "WHEN 4 THEN 'MF,FW' ELSE 'DF,MF' END",
    "nation": "CASE WHEN c_custkey % 50 = 7 THEN NULL "
              "ELSE concat(lower(substr(n_name, 1, 2)), ' ', upper(substr(n_name, 1, 3))) END",
    "competition": "CASE n_regionkey WHEN 0 THEN 'eng Premier League' WHEN 1 THEN 'es La Liga' "
                   "WHEN 2 THEN 'de Bundesliga' WHEN 3 THEN 'it Serie A' ELSE 'ar Liga Profesional' END",
}
PLAYER_ID = "md5(concat(player_name, '-', CAST(birth_year AS VARCHAR(20)), '-', coalesce(nation, '')))"
PERSON_ID = {"player_id": PLAYER_ID}
EXPOSED = {
    "minutes_90s": "CAST(n_lines AS DOUBLE)",
    "npxg": "CAST(npxg_sum AS DOUBLE) / 100",
    "xag": "CAST(xag_sum AS DOUBLE) / 100",
    "xg": "CAST(npxg_sum + xag_sum AS DOUBLE) / 100",
}
KEEPER = {
    "goals_against": "goals",
    "save_pct": "CASE WHEN n_lines >= 6 THEN 100 * CAST(takeons_won AS DOUBLE) / n_lines END",
    "clean_sheet_pct": "100 * CAST(interceptions AS DOUBLE) / n_lines",
    "psxg": "CAST(npxg_sum AS DOUBLE) / 100",
    "psxg_plus_minus": "CAST(npxg_sum - xag_sum AS DOUBLE) / 100",
    "crosses_stopped_pct": "CASE WHEN crosses > 0 THEN 100 * CAST(aerials_won AS DOUBLE) / n_lines END",
    "sweeper_actions": "recoveries",
    "long_pass_completion_pct": "100 * CAST(key_passes AS DOUBLE) / n_lines",
}
PANEL_COLUMNS = ["player_id", "squad", "season_id", *PERSON, *EXPOSED, *COUNTS]
KEEPER_COLUMNS = ["player_id", "squad", "season_id", *PERSON, "minutes_90s", *KEEPER]


def _sql(fragments: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in fragments.items())


# --- SQL side -------------------------------------------------------------

PERSONS_SQL = f"""
persons0 AS (
  SELECT c_custkey, {_sql(PERSON)}
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
persons AS (SELECT *, {_sql(PERSON_ID)} FROM persons0)"""

COUNTED_SQL = f"""
line_sums AS (SELECT l_orderkey, {_sql(LINE_MEASURES)} FROM lineitem GROUP BY l_orderkey),
counted AS (
  SELECT o_custkey, o_orderpriority AS squad, CAST(year(o_orderdate) AS VARCHAR) AS season_id,
         {", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in LINE_MEASURES)}
  FROM orders JOIN line_sums ON o_orderkey = l_orderkey GROUP BY ALL)"""

PANEL_SQL = f"""{PERSONS_SQL}, {COUNTED_SQL},
panel_all AS (SELECT *, {_sql(EXPOSED)}, {_sql(KEEPER)} FROM counted JOIN persons ON o_custkey = c_custkey),
panel AS (SELECT {", ".join(PANEL_COLUMNS)} FROM panel_all),
keeper_panel AS (SELECT {", ".join(KEEPER_COLUMNS)} FROM panel_all WHERE primary_position = 'GK')"""

ROLE_SQL = """CASE WHEN primary_position IS NULL THEN 'Unknown'
  WHEN primary_position LIKE '%GK%' THEN 'Goalkeeper'
  WHEN primary_position LIKE '%MF%' AND primary_position LIKE '%FW%' THEN 'Winger/AM'
  WHEN primary_position LIKE '%DF%' AND primary_position LIKE '%MF%' THEN 'Wingback/DM'
  WHEN primary_position LIKE '%FW%' THEN 'Attacker'
  WHEN primary_position LIKE '%MF%' THEN 'Midfielder'
  WHEN primary_position LIKE '%DF%' THEN 'Defender' ELSE 'Other' END"""

RATED_SQL = f"""{PANEL_SQL},
rated AS (
  SELECT *, {ROLE_SQL} AS scouting_role, (2026 - birth_year) <= 23 AS is_u23_prospect,
    CAST(goals + assists AS DOUBLE) / minutes_90s AS goal_contribution_per_90,
    (npxg + xag) / minutes_90s AS expected_contribution_per_90,
    CAST(pass_progressive_distance + carry_progressive_distance AS DOUBLE) / minutes_90s AS progression_total_dist_per_90,
    CAST(tackles_won + interceptions + recoveries AS DOUBLE) / minutes_90s AS defensive_actions_per_90,
    goals - xg AS goals_vs_xg, npxg / nullif(shots_total, 0) AS npxg_per_shot,
    CAST(aerials_won * 100 AS DOUBLE) / nullif(aerials_won + aerials_lost, 0) AS aerial_win_pct
  FROM panel WHERE minutes_90s >= 5.0)"""

SCOUTING_SQL = f"""{RATED_SQL},
scouting AS (
  SELECT *,
    percent_rank() OVER (PARTITION BY season_id, primary_position ORDER BY expected_contribution_per_90 NULLS LAST) AS percentile_attacking,
    percent_rank() OVER (PARTITION BY season_id, primary_position ORDER BY progression_total_dist_per_90 NULLS LAST) AS percentile_progression,
    percent_rank() OVER (PARTITION BY season_id, primary_position ORDER BY defensive_actions_per_90 NULLS LAST) AS percentile_defense
  FROM rated)"""

KEEPERS_SQL = f"""
keeper_rated AS (
  SELECT *, psxg_plus_minus / minutes_90s AS psxg_plus_minus_per_90,
    CAST(sweeper_actions AS DOUBLE) / minutes_90s AS sweeper_actions_per_90,
    (2026 - birth_year) <= 23 AS is_u23_prospect
  FROM keeper_panel WHERE minutes_90s >= 5.0),
keepers AS (
  SELECT *,
    percent_rank() OVER (PARTITION BY season_id ORDER BY psxg_plus_minus_per_90 NULLS LAST) AS percentile_shot_stopping,
    percent_rank() OVER (PARTITION BY season_id ORDER BY crosses_stopped_pct NULLS LAST) AS percentile_command,
    percent_rank() OVER (PARTITION BY season_id ORDER BY sweeper_actions_per_90 NULLS LAST) AS percentile_sweeping,
    percent_rank() OVER (PARTITION BY season_id ORDER BY long_pass_completion_pct NULLS LAST) AS percentile_distribution
  FROM keeper_rated)"""

# --- Spark side -----------------------------------------------------------


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = spark.sql(f"""SELECT c_custkey, {_sql(PERSON)}
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
                          customer=table(spark, sf_dir, "customer"), nation=table(spark, sf_dir, "nation"))
    return described.selectExpr("*", *[f"{e} AS {n}" for n, e in PERSON_ID.items()])


def line_sums(spark: SparkSession, sf_dir: str, measures=tuple(LINE_MEASURES), where: str = "true") -> DataFrame:
    """Measures per order."""
    return spark.sql(f"""SELECT l_orderkey, {_sql({m: LINE_MEASURES[m] for m in measures})}
        FROM {{lineitem}} WHERE {where} GROUP BY l_orderkey""", lineitem=table(spark, sf_dir, "lineitem"))


def counted(spark: SparkSession, sf_dir: str, measures=tuple(LINE_MEASURES), where: str = "true",
            sums: DataFrame | None = None) -> DataFrame:
    """Measures per (o_custkey, squad, season_id); ``sums`` are those per order, if they are at hand.

    Lines collapse to one row per order before the join, so an order or customer with most of
    the lines never reaches a join as raw rows.
    """
    return spark.sql(f"""
        SELECT o_custkey, o_orderpriority AS squad, CAST(year(o_orderdate) AS STRING) AS season_id,
               {", ".join(f"sum({m}) AS {m}" for m in measures)}
        FROM {{orders}} JOIN {{line_sums}} ON o_orderkey = l_orderkey
        GROUP BY o_custkey, o_orderpriority, year(o_orderdate)""",
                     line_sums=line_sums(spark, sf_dir, measures, where) if sums is None else sums,
                     orders=table(spark, sf_dir, "orders"))


def counted_parts(spark: SparkSession, sf_dir: str, parts: Sequence[tuple[Sequence[str], str]]) -> list[DataFrame]:
    """One table of measures per (measures, condition on lines), all from a single pass over the lines, stored."""
    sums, totals = [], []
    for i, (measures, where) in enumerate(parts):
        sums.append(f"count(*) FILTER (WHERE {where}) AS lines{i}")
        sums += [f"{LINE_MEASURES[m]} FILTER (WHERE {where}) AS part{i}_{m}" for m in measures]
        totals += [f"lines{i}", *[f"part{i}_{m}" for m in measures]]
    stored = materialize(spark.sql(f"""
        WITH line_sums AS (SELECT l_orderkey, {", ".join(sums)} FROM {{lineitem}} GROUP BY l_orderkey)
        SELECT o_custkey, o_orderpriority AS squad, CAST(year(o_orderdate) AS STRING) AS season_id,
               {", ".join(f"sum({t}) AS {t}" for t in totals)}
        FROM {{orders}} JOIN line_sums ON o_orderkey = l_orderkey
        GROUP BY o_custkey, o_orderpriority, year(o_orderdate)""",
        lineitem=table(spark, sf_dir, "lineitem"), orders=table(spark, sf_dir, "orders")), "parts")
    return [stored.where(f"lines{i} > 0").select("o_custkey", "squad", "season_id",
                                                 *[F.col(f"part{i}_{m}").alias(m) for m in measures])
            for i, (measures, _) in enumerate(parts)]


def _panel_all(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None) -> DataFrame:
    counts = counted(spark, sf_dir) if counts is None else counts
    rows = counts.join(persons(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    return rows.selectExpr("*", *[f"{e} AS {n}" for n, e in {**EXPOSED, **KEEPER}.items()])


def both_panels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Outfield and keeper panel from one pass over the lines, stored in between."""
    rows = materialize(_panel_all(spark, sf_dir), "panel")
    return rows.select(*PANEL_COLUMNS), rows.where("primary_position = 'GK'").select(*KEEPER_COLUMNS)


def panel_with_keepers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both panels in one. Sums and counts are stored on the way, so that shuffles of one step can go before the next."""
    path = new_path(spark, "counted")
    with scratch(spark):
        counts = stored(counted(spark, sf_dir, sums=materialize(line_sums(spark, sf_dir), "sums")), path)
    return _panel_all(spark, sf_dir, counts).select(*PANEL_COLUMNS, *KEEPER)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel_all(spark, sf_dir).select(*PANEL_COLUMNS)


def keeper_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel_all(spark, sf_dir).where("primary_position = 'GK'").select(*KEEPER_COLUMNS)
