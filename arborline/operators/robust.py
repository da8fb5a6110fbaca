"""Robust normalisation within groups: quartile scaling, robust z, min-max by deciles, season z."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborline.config import EPS
from arborline.functions.quantiles import with_quantiles
from arborline.functions.scalars import clamp, num

QUARTILES = (0.25, 0.5, 0.75)


def _z(c: str) -> Column:
    q = F.col(f"{c}__q")
    return clamp((F.col(c) - q[1]) / F.greatest(q[2] - q[0], num(EPS)), -3, 3)


def robust_z(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Add (x - median) / interquartile range, held to -3..3, of each column (input name -> output name) within groups of keys."""
    out = with_quantiles(df, keys, list(columns), QUARTILES)
    return out.withColumns({new: _z(c) for c, new in columns.items()}).drop(*[f"{c}__q" for c in columns])


def robust_scale01(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], inverted: Sequence[str] = ()) -> DataFrame:
    """Add the robust z mapped to 0..1; of the columns in ``inverted`` one less it."""
    out = with_quantiles(df, keys, list(columns), QUARTILES)
    scaled = {c: (_z(c) + num(3)) / num(6) for c in columns}
    return out.withColumns({new: num(1) - scaled[c] if c in inverted else scaled[c] for c, new in columns.items()}).drop(*[f"{c}__q" for c in columns])


def robust_minmax(df: DataFrame, keys: Sequence[str], column: str, out: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Add the place of a value between two quantiles of its group, held to 0..1; 0 without a range, a value or a whole key."""
    q = F.col(f"{column}__q")
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    place = F.when(whole & (q[1] - q[0] > 1e-9), clamp((F.col(column) - q[0]) / (q[1] - q[0]), 0, 1))
    return with_quantiles(df, keys, [column], (low, high)).withColumn(out, F.coalesce(place, num(0))).drop(f"{column}__q")


def season_z(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """Add (x - mean) / population deviation; with no deviation (x - median) / (range of quartiles / 1.349), by 1 if that is 0 too."""
    joined = with_quantiles(df, keys, [column], QUARTILES)
    moments = df.groupBy(*keys).agg(F.avg(column).alias("mean__"), F.stddev_pop(column).alias("sd__")).select(*[F.col(k).alias(f"{k}__k") for k in keys], "mean__", "sd__")
    on = F.lit(True)
    for k in keys:
        on = on & joined[k].eqNullSafe(moments[f"{k}__k"])
    joined = joined.join(moments, on).drop(*[f"{k}__k" for k in keys])
    q, mean, sd = F.col(f"{column}__q"), F.col("mean__"), F.col("sd__")
    spread = (q[2] - q[0]) / num(1.349)
    robust = (F.col(column) - q[1]) / F.when(spread > 0, spread).otherwise(num(1))
    return joined.withColumn(out, F.when(sd > 0, F.try_divide(F.col(column) - mean, sd)).otherwise(robust)).drop(f"{column}__q", "mean__", "sd__")
