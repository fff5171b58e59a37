"""Labels and score formulas of the scouting marts."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from .. import fixed_values as V


def role_of(position: Column) -> Column:
    """Scouting role of a raw position such as ``MF,FW``."""
    has = position.contains
    return (
        F.when(position.isNull(), "Unknown")
        .when(has("GK"), "Goalkeeper")
        .when(has("MF") & has("FW"), "Winger/AM")
        .when(has("DF") & has("MF"), "Wingback/DM")
        .when(has("FW"), "Attacker")
        .when(has("MF"), "Midfielder")
        .when(has("DF"), "Defender")
        .otherwise("Other")
    )


def cohort_flag(birth_year: Column, reference_year: int = V.COHORT_REFERENCE_YEAR,
                max_age: int = V.COHORT_MAX_AGE) -> Column:
    """True for entities at most ``max_age`` in ``reference_year``; NULL counts as False."""
    return F.coalesce(F.lit(reference_year) - birth_year <= max_age, F.lit(False))


def risk_rating(seasons: Column, volatility: Column, form: Column,
                volatility_limit: float = V.VOLATILITY_LIMIT, form_limit: float = V.FORM_LIMIT) -> Column:
    return (
        F.when(seasons < 2, V.RISK_NEW)
        .when(volatility > volatility_limit, V.RISK_HIGH)
        .when(form < form_limit, V.RISK_DECLINING)
        .otherwise(V.RISK_SAFE)
    )


def performance_tier(attack: Column, defence: Column) -> Column:
    """Tier from the attacking and defensive peer percentiles (0 to 1)."""
    best = F.greatest(attack, defence)
    return (
        F.when(best > 0.90, V.TIER_S)
        .when(best > 0.75, V.TIER_A)
        .when(attack > 0.50, V.TIER_B)
        .otherwise(V.TIER_C)
    )


def without_country(competition: Column) -> Column:
    """``eng Premier League`` gives ``Premier League``."""
    return F.regexp_replace(competition, "^[a-z]{2,3} ", "")


def value_estimate(attack_rate: Column, defence_rate: Column, age: Column, competition: Column) -> Column:
    """Value in millions: performance times age factor times league factor, rounded once.

    The double is scaled before it is rounded, as SQL engines round doubles; ``round(x, 1)`` works on its decimal text.
    """
    factors = F.create_map(*[F.lit(x) for x in chain.from_iterable(V.LEAGUE_FACTORS.items())])
    league = F.coalesce(F.try_element_at(factors, without_country(competition)), F.lit(V.OTHER_LEAGUE_FACTOR))
    by_age = (F.when(age < V.YOUNG_AGE, V.YOUNG_FACTOR).when(age > V.OLD_AGE, V.OLD_FACTOR).otherwise(1.0))
    base = attack_rate * V.ATTACK_WEIGHT + defence_rate * V.DEFENCE_WEIGHT
    return F.round(base * by_age * league * 10) / 10


def squad_status(exposure: Column) -> Column:
    return F.when(exposure < V.KEY_PLAYER_EXPOSURE, "Fringe").otherwise("Key Player")


def specialist_index(position: Column, progression: Column, defence: Column, keeper: Column,
                     attack: Column) -> Column:
    """The one rate that matters most for the position."""
    return (
        F.when(position.isin(V.PROGRESSION_POSITIONS), progression)
        .when(position.isin(V.DEFENCE_POSITIONS), defence)
        .when(position == V.KEEPER_POSITION, keeper)
        .otherwise(attack)
    )


def quadrant(x: Column, y: Column, x_line: Column, y_line: Column) -> Column:
    """Place of a point against the two reference lines."""
    right, top = x >= x_line, y >= y_line
    return (
        F.when(right & top, "Elite")
        .when(right & ~top, "Specialist")
        .when(~right & top, "Efficient")
        .when(~right & ~top, "Developing")
    )
