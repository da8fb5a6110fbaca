"""The panel, its trends and assignments, from the supplied star schema: suppliers stand for entities, ship years for seasons, months for windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed
from arborline.config import Settings
from arborline.functions import scalars as S
from arborline.operators import clusters, trends
from arborline.operators.analysis import group_medians
from arborline.operators.robust import robust_z
from arborline.operators.serving import served

#: Frozen centres of (slope, level), and of the summer index.
CENTERS = [[0.96, 1.04], [-0.21, -0.21]]
AGE_CENTERS = [-0.8, 0.6]
SETTINGS = Settings()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def season(year) -> F.Column:
    return F.concat(year.cast("string"), F.lit("_"), (year + 1).cast("string"))


def window(day: F.Column) -> F.Column:
    """Twelve months on eight windows; the last four come round to the first."""
    return ((F.month(day) - F.lit(1)) % F.lit(8) + F.lit(1)).cast("int")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an entity, season and window, with mean and deviation of two measures and the valid fraction."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_returnflag")
    price, valid = F.col("l_extendedprice") / F.lit(1e5), F.when(F.col("l_returnflag") != "N", 1.0).otherwise(0.0)
    return lines.groupBy(F.col("l_suppkey").cast("string").alias("orch_id"), F.year("l_shipdate").alias("season_sort"), window(F.col("l_shipdate")).alias("time_period")).agg(
        F.avg(price).alias("savi_mean"), F.stddev_pop(price).alias("savi_sd"), F.avg("l_discount").alias("bsi_mean"), F.stddev_pop("l_discount").alias("bsi_sd"), F.avg(valid).alias("valid_pixel_fraction"),
    )


def rewarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.rewards(checkpointed(panel(spark, sf_dir)))


def trended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.with_quality(trends.trends(rewarded(spark, sf_dir), SETTINGS)).withColumn("season", season(F.col("season_sort")))


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entity and season with enough periods, at its nearest frozen centre."""
    rows = trended(spark, sf_dir).where((F.col("n_periods_used") >= SETTINGS.min_periods) & (F.col("Q") >= SETTINGS.assign_min_quality))
    near = clusters.nearest(trends.features(rows, "cover2", SETTINGS.shrink), ["f_1", "f_2"], CENTERS, SETTINGS.confidence_threshold, SETTINGS.distance_threshold)
    return checkpointed(clusters.labelled(near, clusters.label_map(CENTERS, SETTINGS.label_schema)))


def ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(season, orch_id, CMI_z, cmi_cluster, cmi_label): the summer index, here the median quantity, by its nearest centre."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("orch_id"), F.year("l_shipdate").alias("season_sort"), "l_quantity")
    index = robust_z(checkpointed(group_medians(lines, ["season_sort", "orch_id"])), ["season_sort"], {"CMI__l_quantity": "CMI_z"})
    near = clusters.nearest(index.where("CMI_z is not null"), ["CMI_z"], [[c] for c in AGE_CENTERS])
    named = clusters.labelled(near, clusters.age_labels(AGE_CENTERS), out="cmi_label")
    return checkpointed(named.select(season(F.col("season_sort")).alias("season"), "season_sort", "orch_id", "CMI_z", F.col("cluster").alias("cmi_cluster"), "cmi_label"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpointed(served(assigned(spark, sf_dir), ["f_1", "f_2"], ages(spark, sf_dir).select("season", "orch_id", "CMI_z", "cmi_label")))


#: The same steps as DuckDB SQL, each a common table expression over those before it.
_Z = "least(3, greatest(-3, ({c} - {q}[2]) / greatest({q}[3] - {q}[1], 1e-6)))"
_ONE = lambda c, q: "(" + _Z.format(c=c, q=q) + " + 3) / 6"
_CLIP = "least(1.0, greatest(0.0, {x}))"
_HIGH = lambda x: _CLIP.format(x=f"({x} - 0.5) / 0.3")
_RW = ("Intensity", "Fill", "Uniformity")
_each = lambda text: ", ".join(text.format(r=r) for r in _RW)
_D = lambda a, b: f"sqrt((f_1 - {a}) * (f_1 - {a}) + (f_2 - {b}) * (f_2 - {b}))"

STEPS = {
    "obs": """SELECT l_suppkey::VARCHAR AS orch_id, year(l_shipdate)::INTEGER AS season_sort, ((month(l_shipdate) - 1) % 8 + 1)::INTEGER AS time_period, avg(l_extendedprice / 1e5) AS savi_mean, stddev_pop(l_extendedprice / 1e5) AS savi_sd,
  avg(l_discount) AS bsi_mean, stddev_pop(l_discount) AS bsi_sd, avg(CASE WHEN l_returnflag <> 'N' THEN 1.0::DOUBLE ELSE 0.0 END) AS valid_pixel_fraction FROM lineitem GROUP BY ALL""",
    "kept": """SELECT *, savi_sd / (abs(savi_mean) + 1e-6) AS cv_savi, bsi_sd / (abs(bsi_mean) + 1e-6) AS cv_bsi FROM obs WHERE NOT (abs(savi_mean) <= 1e-6 AND abs(bsi_mean) <= 1e-6 AND abs(savi_sd) <= 1e-6 AND abs(bsi_sd) <= 1e-6)""",
    "quart": """SELECT season_sort, time_period, quantile_cont(savi_mean, [.25, .5, .75]) AS qs, quantile_cont(bsi_mean, [.25, .5, .75]) AS qb, quantile_cont(cv_savi, [.25, .5, .75]) AS qcs, quantile_cont(cv_bsi, [.25, .5, .75]) AS qcb FROM kept GROUP BY ALL""",
    "scaled": f"""SELECT kept.*, {_ONE("savi_mean", "qs")} AS savi_rz, 1 - {_ONE("bsi_mean", "qb")} AS bsi_green, 0.5 * (1 - {_ONE("cv_savi", "qcs")}) + 0.5 * (1 - {_ONE("cv_bsi", "qcb")}) AS Uniformity, 0.3 + 0.4 * (least(7.0, greatest(2.0, time_period)) - 2) / 5 AS pw FROM kept JOIN quart USING (season_sort, time_period)""",
    "rew": f"""SELECT *, pw * savi_rz + (1 - pw) * bsi_green AS Intensity, 0.5 * {_HIGH("savi_rz")} + 0.5 * {_HIGH("bsi_green")} AS Fill FROM scaled""",
    "pts": """SELECT *, CASE WHEN valid_pixel_fraction > 0 THEN valid_pixel_fraction ELSE 1 / (savi_sd + bsi_sd + 1e-6) END AS w, time_period::DOUBLE AS t FROM rew WHERE time_period BETWEEN 3 AND 7""",
    "means": f"""SELECT season_sort, orch_id, count(*) AS n, sum(w * w * t) / sum(w * w) AS mt, {_each("sum(w * w * {r}) / sum(w * w) AS my_{r}, sum(w * {r}) / sum(w) AS wy_{r}")}, min(t) AS t0, max(t) AS t1 FROM pts GROUP BY ALL""",
    "lines": f"""SELECT season_sort, orch_id, any_value(n) AS n, any_value(mt) AS mt, any_value(t0) AS t0, any_value(t1) AS t1, {_each("any_value(my_{r}) AS my_{r}, any_value(wy_{r}) AS wy_{r}, sum(w * w * (t - mt) * ({r} - my_{r})) / nullif(sum(w * w * (t - mt) * (t - mt)), 0) AS m_{r}")} FROM pts JOIN means USING (season_sort, orch_id) GROUP BY ALL""",
    "fitted": f"""SELECT *, {_each("CASE WHEN n >= 2 THEN CASE WHEN t0 = t1 THEN my_{r} / (2 * t0) ELSE m_{r} END END AS slope_{r}, CASE WHEN n >= 2 THEN CASE WHEN t0 = t1 THEN my_{r} / 2 ELSE my_{r} - m_{r} * mt END END AS intercept_{r}")} FROM lines""",
    "r2": f"""SELECT season_sort, orch_id, {_each("CASE WHEN any_value(n) >= 2 THEN 1 - sum(w * ({r} - slope_{r} * t - intercept_{r}) ^ 2) / (sum(w * ({r} - wy_{r}) ^ 2) + 1e-6) END AS r2_{r}")} FROM pts JOIN fitted USING (season_sort, orch_id) GROUP BY ALL""",
    "trend": f"""SELECT p.season_sort, p.orch_id, coalesce(n, 0)::INTEGER AS n_periods_used, {_each("slope_{r}, intercept_{r}, r2_{r}")}, intercept_Intensity + 5 * slope_Intensity AS pred_Intensity_t5
  FROM (SELECT DISTINCT season_sort, orch_id FROM rew) p LEFT JOIN fitted USING (season_sort, orch_id) LEFT JOIN r2 USING (season_sort, orch_id)""",
    "tq": f"""SELECT season_sort, {_each("quantile_cont(slope_{r}, [.25, .5, .75]) AS q_{r}")}, quantile_cont(pred_Intensity_t5, [.25, .5, .75]) AS ql FROM trend GROUP BY ALL""",
    "zed": "SELECT trend.*, season_sort || '_' || (season_sort + 1) AS season, "
    + ", ".join(f"CASE WHEN slope_{r} IS NOT NULL THEN {_Z.format(c=f'slope_{r}', q=f'q_{r}')} END AS z_slope_{r}" for r in _RW)
    + f", CASE WHEN pred_Intensity_t5 IS NOT NULL THEN {_Z.format(c='pred_Intensity_t5', q='ql')} END AS z_level_Intensity_t5 FROM trend JOIN tq USING (season_sort)",
    "qual": """SELECT *, coalesce(least(1, greatest(0, list_avg(list_filter([r2_Intensity, r2_Fill, r2_Uniformity], lambda x: x IS NOT NULL)) * least(n_periods_used / 5, 1))), 0) AS Q FROM zed""",
    "feat": f"""SELECT *, z_slope_Intensity * sqrt({_CLIP.format(x="r2_Intensity")}) AS f_1, z_level_Intensity_t5 AS f_2 FROM qual WHERE n_periods_used >= 2 AND Q >= 0""",
    "near": f"""SELECT *, {_D(*CENTERS[0])} AS da, {_D(*CENTERS[1]).replace("- -", "+ ")} AS db FROM feat""",
    "asg": """SELECT *, CASE WHEN da <= db THEN 0 ELSE 1 END AS cluster, least(da, db) AS d1, greatest(da, db) AS d2, 1 - least(da, db) / (da + db) AS best_soft,
  CASE WHEN 1 - least(da, db) / (da + db) < 0.6 OR least(da, db) > 1.5 THEN 1 ELSE 0 END AS uncertain, CASE WHEN da <= db THEN 'Likely Cover Cropping' ELSE 'Likely Not Cover Cropping' END AS label FROM near""",
    "idx": """SELECT year(l_shipdate)::INTEGER AS season_sort, l_suppkey::VARCHAR AS orch_id, median(l_quantity) AS v FROM lineitem GROUP BY ALL""",
    "idxq": "SELECT season_sort, quantile_cont(v, [.25, .5, .75]) AS q FROM idx GROUP BY ALL",
    "age": f"""SELECT *, CASE WHEN abs(CMI_z - {AGE_CENTERS[0]}) <= abs(CMI_z - {AGE_CENTERS[1]}) THEN 0 ELSE 1 END AS cmi_cluster, CASE WHEN abs(CMI_z - {AGE_CENTERS[0]}) <= abs(CMI_z - {AGE_CENTERS[1]}) THEN 'Young' ELSE 'Old' END AS cmi_label
  FROM (SELECT season_sort || '_' || (season_sort + 1) AS season, season_sort, orch_id, {_Z.format(c="v", q="q")} AS CMI_z FROM idx JOIN idxq USING (season_sort))""".replace("- -", "+ "),
    "strat": """SELECT asg.*, cmi_label AS stratum, CMI_z AS env_z_season, CASE WHEN label = 'Likely Cover Cropping' THEN 'Cover Crops' ELSE 'Bare Soil' END AS cluster_role FROM asg LEFT JOIN age USING (season, orch_id)""",
    "sq": "SELECT season_sort, stratum, quantile_cont(best_soft, [.1, .9]) AS q FROM strat GROUP BY ALL",
    "norm": """SELECT strat.*, CASE WHEN strat.stratum IS NOT NULL AND sq.q[2] - sq.q[1] > 1e-9 THEN least(1.0, greatest(0.0, (best_soft - sq.q[1]) / (sq.q[2] - sq.q[1]))) ELSE 0 END AS best_soft_norm
  FROM strat JOIN sq ON strat.season_sort = sq.season_sort AND strat.stratum IS NOT DISTINCT FROM sq.stratum""",
    "prev": """SELECT *, lag(cluster) OVER w AS pc, lag(cluster_role) OVER w AS pr, lag(f_1) OVER w AS p1, lag(f_2) OVER w AS p2, lag(season_sort) OVER w AS ps FROM norm WINDOW w AS (PARTITION BY orch_id ORDER BY season_sort)""",
    "moved": """SELECT *, sqrt((f_1 - p1) ^ 2 + (f_2 - p2) ^ 2) AS dist, coalesce(cluster <> pc, false) AS flipped, sum(CASE WHEN pr IS NULL OR pr <> cluster_role THEN 1 ELSE 0 END) OVER (PARTITION BY orch_id ORDER BY season_sort) AS island FROM prev""",
    "seq": """SELECT *, row_number() OVER (PARTITION BY orch_id, island ORDER BY season_sort) AS streak_len_current,
  (season_sort - max(CASE WHEN flipped THEN season_sort END) OVER (PARTITION BY orch_id ORDER BY season_sort))::DOUBLE AS time_since_last_flip FROM moved""",
}


def sql(select: str, upto: str) -> str:
    """The steps up to one of them, then a query over them."""
    names = list(STEPS)
    used = names[: names.index(upto) + 1]
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in used) + f"\n{select}"
