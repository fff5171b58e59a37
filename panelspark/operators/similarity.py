"""Standardised features and nearest neighbours of one entity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import fixed_values as V
from .joins import join_same, with_one_row


def style_columns(df: DataFrame, exclude: Sequence[str] = tuple(V.NOT_STYLE_COLUMNS)) -> list[str]:
    """Numeric columns that describe style: no attributes, exposures, shares or ranks."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude
            and "pct" not in f.name and not f.name.startswith("percentile")]


def _moments(df: DataFrame, keys: Sequence[str], features: Sequence[str], *more: Column) -> DataFrame:
    filled = {f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features}
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"__avg_{f}") for f, c in filled.items()],
                                 *[F.stddev_samp(c).alias(f"__sd_{f}") for f, c in filled.items()], *more)


def _z(feature: str) -> Column:
    value = F.coalesce(F.col(feature).cast("double"), F.lit(0.0))
    return F.when(F.col(f"__sd_{feature}") > 0, (value - F.col(f"__avg_{feature}")) / F.col(f"__sd_{feature}"))


def zscores(df: DataFrame, keys: Sequence[str], features: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Z-score of each feature in its peer group (NULL as 0, sample deviation).

    NULL where a feature is constant in the group. Mean and deviation come from one partial
    aggregation instead of a window, so a huge group is never gathered.
    """
    joined = join_same(df, _moments(df, keys, features), keys)
    return joined.withColumns({f"{prefix}{f}": _z(f) for f in features}).drop(
        *[f"__{p}_{f}" for p in ("avg", "sd") for f in features])


def similar_entities(df: DataFrame, target: DataFrame, features: Sequence[str], entity: str = "player_id",
                     peer_keys: Sequence[str] = ("season_id", "primary_position"), k: int = 5,
                     min_peers: int = 5, tie_break: Sequence[str] = ("player_id", "squad")) -> DataFrame:
    """The k peers of one target row with the closest z-scored features; similarity = 1 / (1 + distance).

    Empty unless the group has more than ``min_peers`` rows. Features constant in the group carry no
    information and are left out. The target is limited to one row, so it is safe to broadcast; the
    statistics of its group are one row too. The peers are only streamed.
    """
    one = target.limit(1)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in peer_keys])
    keyed = one.select(*[F.col(c).alias(f"__k_{c}") for c in peer_keys], F.col(entity).alias("__target"),
                       *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"__t_{f}") for f in features])
    peers = df.join(F.broadcast(keyed), same, "inner")
    stats = _moments(peers, [], features, F.count(F.lit(1)).alias("__size"))
    gaps = [F.coalesce(F.pow(_z(f) - (F.col(f"__t_{f}") - F.col(f"__avg_{f}")) / F.col(f"__sd_{f}"), F.lit(2)),
                       F.lit(0.0)) for f in features]
    gaps = [F.when(F.col(f"__sd_{f}") > 0, g).otherwise(0.0) for f, g in zip(features, gaps)]
    distance = F.sqrt(reduce(lambda a, b: a + b, gaps))
    scored = (with_one_row(peers, stats)
              .where((F.col("__size") > min_peers) & (F.col(entity) != F.col("__target")))
              .withColumn("distance", distance))
    return (scored.withColumn("similarity", 1 / (1 + F.col("distance"))).select(*df.columns, "distance", "similarity")
            .orderBy("distance", *tie_break).limit(k))


def nearest_vectors(df: DataFrame, target: DataFrame, vector: str, entity: str, peer_keys: Sequence[str] = (),
                    k: int = 5) -> DataFrame:
    """The k Euclidean neighbours of one target vector among the rows of its peer group."""
    one = target.limit(1).select(*[F.col(c).alias(f"__k_{c}") for c in peer_keys], F.col(entity).alias("__target"),
                                 F.col(vector).alias("__vector"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in peer_keys],
                  F.col(entity) != F.col("__target"))
    gap = F.zip_with(F.col(vector), F.col("__vector"),
                     lambda a, b: F.pow(a.cast("double") - b.cast("double"), F.lit(2)))
    distance = F.sqrt(F.aggregate(gap, F.lit(0.0), lambda acc, g: acc + g))
    near = df.join(F.broadcast(one), same, "inner").withColumn("distance", distance)
    return (near.withColumn("similarity", 1 / (1 + F.col("distance"))).select(*df.columns, "distance", "similarity")
            .orderBy("distance", entity).limit(k))
