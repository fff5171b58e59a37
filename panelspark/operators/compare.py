"""Profile of one entity against its peers, and of two entities against each other.

The percentile of one row needs no ranking: counting lower and equal peers is
enough, so a profile is one aggregation with partial counts whatever the group size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V

Menu = Sequence[tuple[str, str, str]]


def newest_record(df: DataFrame, entity: Column, order: Sequence[str] = ("season_id", "squad")) -> DataFrame:
    """The one row of an entity that profiles describe: its latest period."""
    return df.where(entity).orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(1)


def metric_profile(df: DataFrame, target: DataFrame, menu: Menu, peer_keys: Sequence[str] = ("season_id",
                   "primary_position"), lower_is_better: Sequence[str] = tuple(V.LOWER_IS_BETTER)) -> DataFrame:
    """(menu_position, category, metric, percentile, raw) of the target row among its peers.

    Menu entries whose column is missing are skipped. ``target`` is limited to one row, which is
    what makes it safe to broadcast.
    """
    present = [(i, cat, c, label) for i, (cat, c, label) in enumerate(menu, 1) if c in df.columns]
    measures = [c for _, _, c, _ in present]
    one = target.limit(1).select(*[F.col(k).alias(f"__k_{k}") for k in peer_keys],
                                 *[F.col(c).cast("double").alias(f"__t_{c}") for c in measures])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in peer_keys])
    peers = df.select(*peer_keys, *measures).join(F.broadcast(one), same, "inner")
    counts = []
    for c in measures:
        mine, other = F.col(f"__t_{c}"), F.col(c).cast("double")
        worse = other > mine if c in lower_is_better else other < mine
        counts += [F.sum(worse.cast("int")).alias(f"__w_{c}"), F.sum((other == mine).cast("int")).alias(f"__e_{c}"),
                   F.count(other).alias(f"__n_{c}"), F.max(mine).alias(f"__x_{c}")]
    entries = [
        F.struct(F.lit(i).alias("menu_position"), F.lit(cat).alias("category"), F.lit(label).alias("metric"),
                 F.when(F.col(f"__x_{c}").isNotNull(),
                        (F.col(f"__w_{c}") + (F.col(f"__e_{c}") + 1) / 2) / F.col(f"__n_{c}") * 100).alias("percentile"),
                 F.col(f"__x_{c}").alias("raw"))
        for i, cat, c, label in present
    ]
    return peers.agg(*counts).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def strengths_weaknesses(profile: DataFrame, per_side: int = V.NOTES_PER_SIDE) -> DataFrame:
    """First metrics in menu order with a high (strength) or low (weakness) percentile."""
    def side(name: str, condition: Column) -> DataFrame:
        first = profile.where(condition).orderBy("menu_position").limit(per_side)
        return first.select(F.lit(name).alias("side"), "menu_position", "metric", "percentile")
    return side("strength", F.col("percentile") >= V.STRENGTH_FROM).unionByName(
        side("weakness", F.col("percentile") <= V.WEAKNESS_TO))


def _both(first: DataFrame, second: DataFrame) -> DataFrame:
    other = second.select("category", "metric", F.col("percentile").alias("percentile_p2"), F.col("raw").alias("raw_p2"))
    mine = first.withColumnRenamed("percentile", "percentile_p1").withColumnRenamed("raw", "raw_p1")
    return mine.join(other, ["category", "metric"], "inner")


def head_to_head(first: DataFrame, second: DataFrame, edge: float = V.CLEAR_EDGE,
                 per_side: int = V.EDGES_PER_SIDE) -> DataFrame:
    """Biggest clear percentile advantages of either entity."""
    diff = _both(first, second).withColumn("diff", F.col("percentile_p1") - F.col("percentile_p2"))

    def side(name: str, condition: Column, order: Column) -> DataFrame:
        best = diff.where(condition).orderBy(order, "menu_position").limit(per_side)
        return best.select(F.lit(name).alias("better"), "category", "metric", "diff")
    return side("first", F.col("diff") > edge, F.desc("diff")).unionByName(
        side("second", F.col("diff") < -edge, F.asc("diff")))


def _stat_text(raw: str, percentile: str) -> Column:
    return F.format_string("%.2f (%d%%)", F.col(raw), F.floor(percentile).cast("int"))


def comparison_table(first: DataFrame, second: DataFrame) -> DataFrame:
    """Raw values with their percentiles side by side, by category."""
    return (_both(first, second)
            .select("category", "metric", "menu_position", _stat_text("raw_p1", "percentile_p1").alias("first"),
                    _stat_text("raw_p2", "percentile_p2").alias("second"), "raw_p1", "raw_p2")
            .orderBy("category", "menu_position"))


def season_breakdown(df: DataFrame, ids: Sequence[str], cards: Sequence[tuple[str, str, str, str, str]]) -> DataFrame:
    """Formatted card texts per row; ``-`` for a missing column or value.

    Values are rounded half up in decimals, after six places, so that noise in the last bits does not show.
    """
    own = set(df.columns)

    def text(column: str, pattern: str, unit: str) -> Column:
        if column not in own:
            return F.lit("-")
        value = F.round(F.round(F.col(column).cast("double"), 6), int(pattern[2])) + F.lit(0.0)
        shown = F.format_string(pattern.replace("%%", "%"), value)
        return F.when(F.col(column).isNotNull(), F.concat(shown, F.lit(unit))).otherwise("-")

    entries = F.explode(F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit(label).alias("label"), text(c, p, u).alias("shown"))
        for section, label, c, p, u in cards]))
    return df.select(*ids, entries.alias("e")).select(*ids, "e.*")
