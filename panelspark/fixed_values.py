"""Values that must equal those of the project whose results we match.

Everything in this file is a fixed value (token, factor, label, list); no logic.
"""

# Token standing for NULL inside a surrogate key.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"

# Name of the column that union_relations adds to tell the sources apart.
SOURCE_COLUMN = "_dbt_source_relation"

# Text of a repeated header line inside a statistics file.
HEADER_PLAYER = "Player"

# Great-circle distance.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934

# Panel grain and exposure.
PANEL_KEYS = ["player_id", "squad", "season_id"]
MIN_EXPOSURE = 5.0
STARTER_EXPOSURE = 15.0
KEY_PLAYER_EXPOSURE = 10.0
COHORT_REFERENCE_YEAR = 2026
COHORT_MAX_AGE = 23

# Value estimate.
LEAGUE_FACTORS = {
    "Premier League": 2.0,
    "La Liga": 1.5,
    "Bundesliga": 1.5,
    "Serie A": 1.2,
    "Ligue 1": 1.2,
}
OTHER_LEAGUE_FACTOR = 1.0
YOUNG_AGE, YOUNG_FACTOR = 23, 1.5
OLD_AGE, OLD_FACTOR = 30, 0.5
ATTACK_WEIGHT, DEFENCE_WEIGHT = 50, 5
UNDERVALUED_BELOW = 30

# Labels.
TIER_S = "S-Tier (Elite)"
TIER_A = "A-Tier (Starter)"
TIER_B = "B-Tier (Rotation)"
TIER_C = "C-Tier (Development)"
RISK_NEW = "Unknown Risk (New Entry)"
RISK_HIGH = "High Risk (Inconsistent)"
RISK_DECLINING = "Declining Risk (Past Peak)"
RISK_SAFE = "Safe Bet (Consistent)"
VOLATILITY_LIMIT = 0.20
FORM_LIMIT = -0.1

# Specialist index by raw position.
PROGRESSION_POSITIONS = ["MF", "MF,DF"]
DEFENCE_POSITIONS = ["DF", "DF,MF"]
KEEPER_POSITION = "GK"

# Characters that canonical decomposition leaves alone.
FOLD_PAIRS = [("ı", "i"), ("İ", "I"), ("ø", "o"), ("ß", "ss")]

# Codes of nations that differ from their ISO code, and the names shown for them.
NATION_FLAG_CODES = {
    "ENG": "gb-eng", "England": "gb-eng",
    "SCT": "gb-sct", "Scotland": "gb-sct",
    "WLS": "gb-wls", "Wales": "gb-wls",
    "NIR": "gb-nir", "Northern Ireland": "gb-nir",
    "USA": "us", "United States": "us",
    "KOR": "kr", "Korea Republic": "kr",
    "CZE": "cz", "Czech Republic": "cz",
    "TUR": "tr", "Türkiye": "tr",
}
NATION_NAMES = {
    "ENG": "England", "SCT": "Scotland", "WLS": "Wales", "NIR": "N. Ireland",
    "USA": "USA", "KOR": "S. Korea", "CZE": "Czechia", "TUR": "Türkiye",
}

# Metric menus: (category, column, label). Lower is better for LOWER_IS_BETTER.
KEEPER_MENU = [
    ("Shot Stopping", "psxg_plus_minus_per_90", "PSxG +/-"),
    ("Shot Stopping", "save_pct", "Save %"),
    ("Shot Stopping", "goals_against", "Goals Conceded"),
    ("Distribution", "long_pass_completion_pct", "Long Pass %"),
    ("Sweeping", "sweeper_actions_per_90", "Sweeper Actions"),
    ("Command", "crosses_stopped_pct", "Crosses Stopped %"),
    ("Command", "clean_sheet_pct", "Clean Sheet %"),
]
OUTFIELD_MENU = [
    ("Attacking", "npxg", "npxG"),
    ("Attacking", "goals", "Goals"),
    ("Attacking", "shots_total", "Shots"),
    ("Attacking", "expected_contribution_per_90", "xG+xAG"),
    ("Attacking", "touches_att_pen", "Touches in Box"),
    ("Passing", "passes_completed", "Passes Cmp"),
    ("Passing", "pass_progressive_distance", "Prog. Pass Dist"),
    ("Passing", "key_passes", "Key Passes"),
    ("Passing", "progressive_passes", "Prog. Passes"),
    ("Passing", "passes_into_penalty_area", "Passes into PA"),
    ("Possession", "touches", "Touches"),
    ("Possession", "carry_progressive_distance", "Carry Dist"),
    ("Possession", "takeons_won", "Dribbles Won"),
    ("Possession", "progressive_carries", "Prog. Carries"),
    ("Possession", "progression_total_dist_per_90", "Total Prog"),
    ("Defending", "tackles_won", "Tackles"),
    ("Defending", "interceptions", "Interceptions"),
    ("Defending", "recoveries", "Recoveries"),
    ("Defending", "aerials_won", "Aerials Won"),
    ("Defending", "defensive_actions_per_90", "Def. Actions"),
]
LOWER_IS_BETTER = ["goals_against"]

# Axes, size and scoring metrics of each role.
ROLE_KPIS = {
    "Attacker": {
        "x": "expected_contribution_per_90", "y": "goal_contribution_per_90", "size": "shots_total",
        "scoring": ["npxg", "goals", "assists", "shots_total", "touches_att_pen"],
    },
    "Winger/AM": {
        "x": "key_passes", "y": "takeons_won", "size": "npxg",
        "scoring": ["key_passes", "takeons_won", "npxg", "assists", "progressive_carries"],
    },
    "Midfielder": {
        "x": "pass_progressive_distance", "y": "key_passes", "size": "minutes_90s",
        "scoring": ["pass_progressive_distance", "key_passes", "interceptions", "tackles_won", "passes_completed"],
    },
    "Defender": {
        "x": "interceptions", "y": "aerials_won", "size": "tackles_won",
        "scoring": ["interceptions", "aerials_won", "tackles_won", "defensive_actions_per_90", "recoveries"],
    },
    "Wingback/DM": {
        "x": "tackles_won", "y": "progression_total_dist_per_90", "size": "interceptions",
        "scoring": ["tackles_won", "progression_total_dist_per_90", "interceptions", "key_passes", "recoveries"],
    },
    "Goalkeeper": {
        "x": "sweeper_actions_per_90", "y": "psxg_plus_minus_per_90", "size": "clean_sheet_pct",
        "scoring": ["psxg_plus_minus_per_90", "save_pct", "clean_sheet_pct", "sweeper_actions_per_90",
                    "long_pass_completion_pct"],
    },
}

# Percentile bounds of the written report.
STRENGTH_FROM, WEAKNESS_TO, NOTES_PER_SIDE = 75, 25, 5
CLEAR_EDGE, EDGES_PER_SIDE = 15, 3

# Age limits shown when no age is known.
FALLBACK_AGES = (15, 45)

# Columns that never describe playing style.
NOT_STYLE_COLUMNS = ["age", "born", "birth_year", "minutes_played", "matches_played", "starts", "season_id",
                     "minutes_90s"]

# Hours after which loaded data counts as stale.
FRESH_WARN_HOURS, FRESH_ERROR_HOURS = 24, 48

# Card layout of one season: (section, label, column, printf format, unit).
OUTFIELD_CARDS = [
    ("Attacking", "Non-Pen xG", "npxg", "%.2f", ""),
    ("Attacking", "Goals", "goals", "%.0f", ""),
    ("Attacking", "Shots Total", "shots_total", "%.0f", ""),
    ("Attacking", "Shots on Target", "shots_on_target", "%.0f", ""),
    ("Attacking", "npxG/Shot", "npxg_per_shot", "%.2f", ""),
    ("Attacking", "Goals - xG", "goals_vs_xg", "%.2f", ""),
    ("Attacking", "Avg Shot Dist", "avg_shot_distance", "%.1f", " yd"),
    ("Passing/Creation", "Exp. Assists (xAG)", "xag", "%.2f", ""),
    ("Passing/Creation", "Assists", "assists", "%.0f", ""),
    ("Passing/Creation", "Key Passes", "key_passes", "%.0f", ""),
    ("Passing/Creation", "Prog. Passes", "progressive_passes", "%.0f", ""),
    ("Passing/Creation", "Passes into Box", "passes_into_penalty_area", "%.0f", ""),
    ("Passing/Creation", "Through Balls", "through_balls", "%.0f", ""),
    ("Passing/Creation", "Switches", "switches", "%.0f", ""),
    ("Passing/Creation", "Crosses", "crosses", "%.0f", ""),
    ("Defense", "Tackles Won", "tackles_won", "%.0f", ""),
    ("Defense", "Interceptions", "interceptions", "%.0f", ""),
    ("Defense", "Blocks", "shots_blocked", "%.0f", ""),
    ("Defense", "Recoveries", "recoveries", "%.0f", ""),
    ("Defense", "Aerials Won", "aerials_won", "%.0f", ""),
    ("Defense", "Aerial Win %", "aerial_win_pct", "%.1f", "%"),
    ("Defense", "Tackles (Att 3rd)", "tackles_att_3rd", "%.0f", ""),
    ("Defense", "Fouls Committed", "fouls_committed", "%.0f", ""),
    ("Possession", "Touches", "touches", "%.0f", ""),
    ("Possession", "Prog. Carries", "progressive_carries", "%.0f", ""),
    ("Possession", "Take-ons Won", "takeons_won", "%.0f", ""),
    ("Possession", "Carries into Box", "carries_into_penalty_area", "%.0f", ""),
    ("Possession", "Touches in Box", "touches_att_pen", "%.0f", ""),
    ("Possession", "Miscontrols", "miscontrols", "%.0f", ""),
    ("Possession", "Dispossessed", "dispossessed", "%.0f", ""),
    ("Possession", "Fouls Drawn", "fouls_drawn", "%.0f", ""),
]
KEEPER_CARDS = [
    ("Shot Stopping", "PSxG +/-", "psxg_plus_minus_per_90", "%.2f", ""),
    ("Shot Stopping", "Save %", "save_pct", "%.1f", "%"),
    ("Shot Stopping", "Goals Against", "goals_against", "%.0f", ""),
    ("Shot Stopping", "Clean Sheet %", "clean_sheet_pct", "%.1f", "%"),
    ("Sweeping", "Sweeper Actions", "sweeper_actions_per_90", "%.2f", ""),
    ("Sweeping", "Crosses Stopped %", "crosses_stopped_pct", "%.1f", "%"),
    ("Sweeping", "Avg Def. Dist", "sweeper_avgdist", "%.1f", " yd"),
    ("Distribution", "Long Pass %", "long_pass_completion_pct", "%.1f", "%"),
    ("Distribution", "Avg Pass Len", "passes_avglen", "%.1f", " yd"),
    ("Distribution", "Goal Kicks Launched", "goal_kicks_launch_pct", "%.1f", "%"),
]
