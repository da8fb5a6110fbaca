"""Rewards of panel rows, weighted trends of each entity and season, quality and features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed
from arborline.config import EPS, Settings
from arborline.functions import scalars as S
from arborline.functions.scalars import num
from arborline.operators.robust import robust_scale01, robust_z

MEASURES = ("savi_mean", "bsi_mean", "savi_sd", "bsi_sd")
REWARDS = ("Intensity", "Fill", "Uniformity")


def drop_missing(panel: DataFrame) -> DataFrame:
    """Panel rows without those whose four measures are all about 0."""
    return panel.where(~S.row_is_missing(*[F.col(m) for m in MEASURES]))


def rewards(panel: DataFrame, strata: Sequence[str] = ()) -> DataFrame:
    """Add savi_rz, bsi_green, cv_savi, cv_bsi and the three rewards, scaled within season, period and strata."""
    rows = drop_missing(panel).withColumns({"cv_savi": S.variation(F.col("savi_mean"), F.col("savi_sd")), "cv_bsi": S.variation(F.col("bsi_mean"), F.col("bsi_sd"))})
    names = {"savi_mean": "savi_rz", "bsi_mean": "bsi_green", "cv_savi": "even_savi", "cv_bsi": "even_bsi"}
    scaled = robust_scale01(rows, ["season_sort", *strata, "time_period"], names, ("bsi_mean", "cv_savi", "cv_bsi"))
    return scaled.withColumns({
        "Intensity": S.intensity(F.col("time_period"), F.col("savi_rz"), F.col("bsi_green")),
        "Fill": S.fill_reward(F.col("savi_rz"), F.col("bsi_green")),
        "Uniformity": num(0.5) * F.col("even_savi") + num(0.5) * F.col("even_bsi"),
    }).drop("even_savi", "even_bsi")


def _sum(points: Column, f) -> Column:
    return F.aggregate(points, num(0), lambda a, p: a + f(p))


def weighted_trend(df: DataFrame, keys: Sequence[str], x: str, ys: Sequence[str], weight: Column, used: Column) -> DataFrame:
    """Per group: n_periods_used, and slope_, intercept_ and r2_ of each y on x over the used rows.

    The line minimises the sum of (weight * residual)^2, while r2 weighs squares by the weight itself. Weights not above 0 count
    as 1e-6; points with a null are left out; fewer than two give nulls; a group without a used row stays, with nulls; of points at one x
    the line of least norm is taken. A group is one entity's season: a handful of periods, kept as one array.
    """
    w = F.when(weight > 0, weight).otherwise(F.when(weight.isNotNull(), num(EPS)))
    point = lambda y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), w.alias("w"))
    whole = lambda y: used & F.col(x).isNotNull() & F.col(y).isNotNull() & w.isNotNull()
    out = df.groupBy(*keys).agg(F.count_if(used).cast("int").alias("n_periods_used"), *[F.collect_list(F.when(whole(y), point(y))).alias(f"p_{y}") for y in ys])
    for y in ys:
        p, slope, intercept = F.col(f"p_{y}"), F.col(f"slope_{y}"), F.col(f"intercept_{y}")
        out = out.withColumns({"sw": _sum(p, lambda e: e["w"] * e["w"]), "x0": F.element_at(F.array_min(F.transform(p, lambda e: F.array(e["x"]))), 1)})
        out = out.withColumns({"mx": F.try_divide(_sum(p, lambda e: e["w"] * e["w"] * e["x"]), F.col("sw")), "my": F.try_divide(_sum(p, lambda e: e["w"] * e["w"] * e["y"]), F.col("sw"))})
        sxy = _sum(p, lambda e: e["w"] * e["w"] * (e["x"] - F.col("mx")) * (e["y"] - F.col("my")))
        sxx = _sum(p, lambda e: e["w"] * e["w"] * (e["x"] - F.col("mx")) * (e["x"] - F.col("mx")))
        one_x = ~F.exists(p, lambda e: e["x"] != F.col("x0"))
        line = F.when(F.size(p) >= 2, F.when(one_x, F.try_divide(F.col("my"), num(2) * F.col("x0"))).otherwise(F.try_divide(sxy, sxx)))
        out = out.withColumns({f"slope_{y}": line, "one_x": one_x})
        out = out.withColumn(f"intercept_{y}", F.when(F.size(p) >= 2, F.when(F.col("one_x"), F.col("my") / num(2)).otherwise(F.col("my") - slope * F.col("mx"))))
        out = out.withColumn("wy", F.try_divide(_sum(p, lambda e: e["w"] * e["y"]), _sum(p, lambda e: e["w"])))
        miss = lambda e: e["y"] - slope * e["x"] - intercept  # noqa: E731, B023
        sse, sst = _sum(p, lambda e: e["w"] * miss(e) * miss(e)), _sum(p, lambda e: e["w"] * (e["y"] - F.col("wy")) * (e["y"] - F.col("wy")))  # noqa: B023
        out = out.withColumn(f"r2_{y}", F.when(F.size(p) >= 2, num(1) - sse / (sst + num(EPS))))
        out = out.drop(f"p_{y}", "sw", "x0", "mx", "my", "one_x", "wy")
    return out


def trends(rewarded: DataFrame, settings: Settings = Settings(), keys: Sequence[str] = ("season_sort", "orch_id")) -> DataFrame:
    """Trends of the rewards over the settings' periods, their robust z within seasons, and the level at the fifth period."""
    weight = S.row_weight(F.col("valid_pixel_fraction"), F.col("savi_sd"), F.col("bsi_sd"), settings.use_valid_fraction)
    fits = weighted_trend(rewarded, keys, "time_period", REWARDS, weight, F.col("time_period").isin(*settings.trend_periods))
    level = checkpointed(fits.withColumn("pred_Intensity_t5", F.col("intercept_Intensity") + num(5) * F.col("slope_Intensity")))
    return robust_z(level, ["season_sort"], {f"slope_{r}": f"z_slope_{r}" for r in REWARDS} | {"pred_Intensity_t5": "z_level_Intensity_t5"})


def with_quality(df: DataFrame) -> DataFrame:
    """Add Q from 0 to 1: the mean of the fits' r2 times the share of five periods used."""
    mean = S.mean_of(*[F.col(f"r2_{r}") for r in REWARDS])
    return df.withColumn("Q", F.coalesce(S.clip01(mean * F.least(F.col("n_periods_used") / num(5), num(1))), num(0)))


#: The feature columns of each feature set.
FEATURE_SETS = {
    "slopes": ("z_slope_Intensity", "z_slope_Fill", "z_slope_Uniformity"),
    "greenup3": ("greenup_slope", "z_level_Intensity_t5", "z_slope_Uniformity"),
    "cover2": ("z_slope_Intensity", "z_level_Intensity_t5"),
    "intensity_slope": ("z_slope_Intensity",),
    "fill_slope": ("z_slope_Fill",),
    "uniformity_slope": ("z_slope_Uniformity",),
}


def features(df: DataFrame, feature_set: str, shrink: str = "sqrt", shrink_level: bool = False) -> DataFrame:
    """Add f_1, f_2, ...: the feature set's columns, each shrunk by its fit; levels only if asked, and greenup3's uniformity never."""
    if feature_set not in FEATURE_SETS:
        raise ValueError(f"unknown feature set {feature_set!r}")
    df = df.withColumn("greenup_slope", num(0.5) * (F.col("z_slope_Intensity") + F.col("z_slope_Fill")))
    green = S.mean_of(F.col("r2_Intensity"), F.col("r2_Fill"))
    kept = {}
    for i, name in enumerate(FEATURE_SETS[feature_set], 1):
        if name == "greenup_slope":
            factor = S.shrink_factor(green, shrink)
        elif name == "z_level_Intensity_t5":
            factor = S.shrink_factor(green if feature_set == "greenup3" else F.col("r2_Intensity"), shrink) if shrink_level else num(1)
        elif feature_set == "greenup3":
            factor = num(1)
        else:
            factor = S.shrink_factor(F.col(name.replace("z_slope_", "r2_")), shrink)
        kept[f"f_{i}"] = F.col(name) * factor
    return df.withColumns(kept).withColumn("shrink_mode", F.lit(shrink))
