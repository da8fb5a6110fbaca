"""Tables for serving: the wide table, attributes of each season, and the manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed
from arborline.functions import scalars as S
from arborline.functions.scalars import num
from arborline.operators.clusters import softness
from arborline.operators.robust import robust_minmax
from arborline.operators.sequences import streaks_so_far

#: Columns of an attributes shard and of the wide table, in order; fixed values.
ATTRIBUTES = ("orch_id", "cluster_role_mapped", "best_soft_norm", "uncertain", "flipped_this_season", "streak_len_current", "time_since_last_flip", "npts_total", "env_z_season", "stratum")

WIDE = {
    "orch_id": "string", "season": "string", "season_sort": "int", "season_mid": "string", "county": "string", "cluster": "int", "label": "string", "cluster_role": "string", "cluster_color": "string",
    "best_soft": "double", "best_soft_norm": "double", "alpha100": "int", "confidence": "double", "p_cover": "double", "stratum": "string", "env_z_season": "double", "npts_total": "int", "z_slope_Intensity": "double",
    "z_level_Intensity_t5": "double", "streak_len_current": "int", "time_since_last_flip": "double", "flip_style_last": "string", "delta_last": "double", **{f"cover_streak_{n}y": "int" for n in range(1, 9)},
}


def served(assigned: DataFrame, features: Sequence[str], ages: DataFrame | None = None, month_day: str = "-01-31") -> DataFrame:
    """The wide table of assignments (orch_id, season, season_sort, cluster, label, best_soft, n_periods_used, features).

    ages: (season, orch_id, CMI_z, cmi_label), or none, which makes every stratum ``Mid``. Entities without an age have no stratum and a
    normalised softness of 0.
    """
    df = softness(assigned)
    if ages is None:
        df = df.withColumns({"stratum": F.lit("Mid"), "env_z_season": num(0)})
    else:
        named = ages.select(F.col("season").alias("s__"), F.col("orch_id").alias("o__"), F.replace(F.initcap("cmi_label"), F.lit("Middle"), F.lit("Mid")).alias("stratum"), F.col("CMI_z").alias("env_z_season"))
        df = df.join(named, (df.season == named.s__) & (df.orch_id == named.o__), "left").drop("s__", "o__")
    # read three times: for the largest group, for quantiles, and to be joined with them
    df = robust_minmax(checkpointed(df), ["season_sort", "stratum"], "best_soft", "best_soft_norm")
    df = df.withColumn("cluster_role", S.role_of(F.col("label"))).withColumns({
        "cluster_color": S.colour_of(F.col("cluster_role")), "alpha100": S.alpha100(F.col("best_soft_norm")), "season_mid": S.season_mid(F.col("season"), month_day),
        "confidence": F.bround("best_soft", 3), "npts_total": F.col("n_periods_used"), "county": F.lit(""),
        "p_cover": F.when(F.col("cluster_role") == "Cover Crops", F.col("best_soft")).otherwise(num(1) - F.col("best_soft")),
    })
    return streaks_so_far(df, features)


def attributes(wide: DataFrame, threshold: float = 0.15, with_bucket: bool = False) -> DataFrame:
    """The attributes of each entity and season, with season_sort to shard by; those that the wide table lacks are left out."""
    out = wide.withColumns({
        "cluster_role_mapped": F.when(F.col("cluster_role") == "Cover Crops", "Cover").otherwise("Bare"),
        "uncertain": F.coalesce("best_soft_norm", num(0)) <= threshold,
        "flipped_this_season": F.coalesce(F.col("time_since_last_flip") == 0, F.lit(False)),
        "confidence_bucket": S.confidence_bucket(F.col("best_soft_norm")),
    })
    return out.select("season_sort", *[c for c in ATTRIBUTES if c in out.columns], *["confidence_bucket"] * with_bucket)


def manifest(wide: DataFrame, threshold: float = 0.15) -> DataFrame:
    """One row: the schema's version, the seasons in order, the threshold and the order of mask bits."""
    years = F.sort_array(F.collect_set(F.col("season_sort").cast("int")))
    return wide.agg(F.lit(1).alias("schema_version"), years.alias("years"), num(threshold).alias("ui_uncertain_threshold"), F.lit("earliest=bit0").alias("bit_order"))


def wide_table(served: DataFrame) -> DataFrame:
    """The wide table's columns, those that are missing as nulls, in order of season and entity."""
    return with_all_columns(served, WIDE).orderBy("season_sort", "orch_id")


def with_all_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly these columns (name -> type); those that df lacks are null."""
    return df.select(*[F.col(c).cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()])


def tile_properties(polygons: DataFrame, first_year: int = 16, last_year: int = 23) -> DataFrame:
    """Properties of map features: county, the commonest crop over the years, the last year's crop, stability and acres."""
    crops = F.array(*[F.col(f"CROP{y}").cast("string") for y in range(first_year, last_year + 1)])
    values = F.array_distinct(crops)
    same = lambda v: F.size(F.filter(crops, lambda c: c.eqNullSafe(v)))
    ranked = F.array_sort(F.transform(values, lambda v: F.struct((-same(v)).alias("n"), v.isNotNull().alias("there"), v.alias("v"))))
    return polygons.select(F.col("orch_id").cast("string").alias("orch_id"), F.col("CNTY").cast("string").alias("county"), ranked[0]["v"].alias("dominant_crop"), F.col(f"CROP{last_year}").cast("string").alias("current_crop"), F.col("stability_score").cast("double").alias("stability_score"), F.col("ACRES").cast("double").alias("acres"))


def with_acres(rows: DataFrame, polygons: DataFrame) -> DataFrame:
    """rows with acres and centroid of their polygon (orch_id, acres, ring); acres missing on record come from the ring. Rows without a polygon get nulls."""
    known = polygons.select("orch_id", S.acres_or_area(F.col("acres"), F.col("ring")).alias("acres"), S.ring_centroid(F.col("ring")).alias("centroid"))
    return rows.join(known, "orch_id", "left")


def require_keys(df: DataFrame, key: str) -> DataFrame:
    """df, after a check that no row lacks the key."""
    missing = df.where(F.col(key).isNull()).count()
    if missing:
        raise ValueError(f"{missing} rows have no {key}")
    return df
