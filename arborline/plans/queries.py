"""The registered queries over the supplied tables, and the DuckDB SQL that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed
from arborline.functions import quantiles
from arborline.functions import scalars as S
from arborline.operators import analysis, clusters, intervals, merging, pixels, robust, sequences, serving, spatial, trends
from arborline.plans import panel as P
from arborline.plans import run as R
from arborline.plans.panel import sql, table
from arborline.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            SQL[f.__name__] = oracle
        return f

    return add


def r6(*names: str) -> list[Column]:
    """Columns to six places; adding 0 makes a negative zero positive."""
    return [(F.round(n, 6) + F.lit(0.0)).alias(n) for n in names]


def q6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in names)


def nudged(*names: str) -> list[Column]:
    """As r6, of decimals whose halves have to be rounded one way in any engine."""
    return [F.round(F.col(n) + F.lit(1e-9), 6).alias(n) for n in names]


KEYS = ("orch_id", "season_sort")

# ---------------------------------------------------------------- panel, scaling, rewards, trends


@query(sql("SELECT orch_id, season_sort, time_period, " + ", ".join(f"round({c} + 1e-9, 6) AS {c}" for c in ("savi_mean", "savi_sd", "bsi_mean", "bsi_sd", "valid_pixel_fraction")) + " FROM obs", "obs"))
def panel_build(spark, d):
    return P.panel(spark, d).select(*KEYS, "time_period", *nudged("savi_mean", "savi_sd", "bsi_mean", "bsi_sd", "valid_pixel_fraction"))


@query(sql("SELECT season_sort, count(*) AS n FROM obs WHERE valid_pixel_fraction >= 0.3 GROUP BY ALL", "obs"))
def missing_row_filter(spark, d):
    gone = F.col("valid_pixel_fraction") < 0.3
    zeroed = P.panel(spark, d).withColumns({m: F.when(gone, 0.0).otherwise(F.col(m)) for m in trends.MEASURES})
    return trends.drop_missing(zeroed).groupBy("season_sort").agg(F.count(F.lit(1)).alias("n"))


@query(sql(f"SELECT orch_id, season_sort, time_period, {q6('savi_rz', 'bsi_green', 'Uniformity')} FROM scaled", "scaled"))
def robust_scale_period(spark, d):
    return P.rewarded(spark, d).select(*KEYS, "time_period", *r6("savi_rz", "bsi_green", "Uniformity"))


@query(sql(f"SELECT orch_id, season_sort, time_period, {q6('Intensity', 'Fill', 'Uniformity')} FROM rew", "rew"))
def reward_composition(spark, d):
    return P.rewarded(spark, d).select(*KEYS, "time_period", *r6("Intensity", "Fill", "Uniformity"))


_FITS = [f"{k}_{r}" for r in trends.REWARDS for k in ("slope", "intercept", "r2")]


@query(sql(f"SELECT orch_id, season_sort, n_periods_used, {q6(*_FITS)} FROM trend", "trend"))
def weighted_trend(spark, d):
    return P.trended(spark, d).select(*KEYS, "n_periods_used", *r6(*_FITS))


_ZS = ("pred_Intensity_t5", "z_slope_Intensity", "z_slope_Fill", "z_slope_Uniformity", "z_level_Intensity_t5")


@query(sql(f"SELECT orch_id, season_sort, {q6(*_ZS)} FROM zed", "zed"))
def robust_z_season(spark, d):
    return P.trended(spark, d).select(*KEYS, *r6(*_ZS))


@query(sql(f"SELECT orch_id, season_sort, {q6('Q')}, Q >= 0.2 AND n_periods_used >= 2 AS train FROM qual", "qual"))
def quality_score(spark, d):
    return P.trended(spark, d).select(*KEYS, *r6("Q"), ((F.col("Q") >= 0.2) & (F.col("n_periods_used") >= 2)).alias("train"))


_R2 = "least(1.0, greatest(0.0, {x}))"
_FACTOR = {
    "sqrt": lambda x: f"sqrt({_R2.format(x=x)})",
    "linear": lambda x: f"least(1.0, greatest(0.0, ({_R2.format(x=x)} - 0.2) / 0.6))",
    "logistic": lambda x: f"1 / (1 + exp(-({_R2.format(x=x)} - 0.5) / 0.1))",
}


def _shrink(mode: str) -> None:
    f = _FACTOR[mode]
    text = sql(f"SELECT orch_id, season_sort, round(z_slope_Intensity * {f('r2_Intensity')}, 6) + 0.0 AS f_1, round(z_level_Intensity_t5 * {f('r2_Intensity')}, 6) + 0.0 AS f_2 FROM qual", "qual")

    def run(spark, d):
        return trends.features(P.trended(spark, d), "cover2", mode, shrink_level=True).select(*KEYS, *r6("f_1", "f_2"))

    run.__name__ = f"shrink_{mode}"
    query(text)(run)


for _mode in _FACTOR:
    _shrink(_mode)


@query(sql(f"SELECT orch_id, season_sort, {', '.join(f'round(z_slope_{r} * ' + _FACTOR['sqrt'](f'r2_{r}') + f', 6) + 0.0 AS f_{i}' for i, r in enumerate(trends.REWARDS, 1))} FROM qual", "qual"))
def feature_slopes(spark, d):
    return trends.features(P.trended(spark, d), "slopes").select(*KEYS, *r6("f_1", "f_2", "f_3"))


@query(sql(f"SELECT orch_id, season_sort, round(0.5 * (z_slope_Intensity + z_slope_Fill) * {_FACTOR['sqrt']('(r2_Intensity + r2_Fill) / 2')}, 6) + 0.0 AS f_1, round(z_level_Intensity_t5, 6) + 0.0 AS f_2, round(z_slope_Uniformity, 6) + 0.0 AS f_3 FROM qual", "qual"))
def feature_greenup3(spark, d):
    return trends.features(P.trended(spark, d), "greenup3").select(*KEYS, *r6("f_1", "f_2", "f_3"))


# ---------------------------------------------------------------- assignment and sequences


@query(sql(f"SELECT orch_id, season_sort, cluster, label, uncertain, {q6('f_1', 'f_2', 'd1', 'd2', 'best_soft')} FROM asg", "asg"))
def nearest_centroid(spark, d):
    return P.assigned(spark, d).select(*KEYS, "cluster", "label", "uncertain", *r6("f_1", "f_2", "d1", "d2", "best_soft"))


_STYLE = "CASE WHEN dist >= 1.25 THEN 'Large' WHEN dist < 0.75 THEN 'Small' ELSE 'Medium' END"


@query(sql(f"SELECT orch_id, ps AS season_from, season_sort AS season_to, flipped::INTEGER AS flip, round(dist, 6) AS distance, {_STYLE} AS magnitude FROM moved WHERE ps IS NOT NULL", "moved"))
def flip_log(spark, d):
    out = sequences.flips(P.assigned(spark, d), ["f_1", "f_2"])
    return out.select("orch_id", "season_from", "season_to", "flip", *r6("distance"), "magnitude")


@query(sql("SELECT season_sort, pc AS from_cluster, cluster AS to_cluster, count(*) AS n FROM moved WHERE pc IS NOT NULL GROUP BY ALL", "moved"))
def transition_counts(spark, d):
    return sequences.transitions(P.assigned(spark, d))


_COVER = ", ".join(f"(cluster_role = 'Cover Crops' AND streak_len_current >= {n})::INTEGER AS cover_streak_{n}y" for n in range(1, 9))


@query(sql(f"SELECT orch_id, season_sort, cluster_role, streak_len_current::INTEGER AS streak_len_current, time_since_last_flip, CASE WHEN flipped THEN {_STYLE} ELSE '' END AS flip_style_last, CASE WHEN flipped THEN round(dist, 6) END AS delta_last, {_COVER} FROM seq", "seq"))
def streaks_and_flips(spark, d):
    return P.wide(spark, d).select(*KEYS, "cluster_role", "streak_len_current", "time_since_last_flip", "flip_style_last", *r6("delta_last"), *[f"cover_streak_{n}y" for n in range(1, 9)])


@query(sql("""SELECT orch_id, bit_or(m) AS mask, max(n) AS longest, sum(n)::BIGINT AS years_active, true AS ever_cover, false AS never_cover FROM (
  SELECT orch_id, i - rn AS g, count(*) AS n, bit_or(1::BIGINT << i) AS m FROM (SELECT *, row_number() OVER (PARTITION BY orch_id ORDER BY i) AS rn FROM (
    SELECT orch_id, (dense_rank() OVER (ORDER BY season_sort) - 1)::INTEGER AS i, cluster_role, best_soft_norm FROM norm) WHERE cluster_role = 'Cover Crops' AND best_soft_norm > 0.15) GROUP BY ALL) GROUP BY orch_id""", "norm"))
def season_masks(spark, d):
    served = P.wide(spark, d)
    seasons = [r[0] for r in served.select("season_sort").distinct().orderBy("season_sort").collect()]  # a handful of years
    return sequences.cover_masks(served, seasons)


@query(sql("""SELECT m.orch_id, count(*) AS n_seasons, sum(CASE WHEN pc IS NULL OR flipped THEN 1 ELSE 0 END)::BIGINT AS flip_count, sum(flipped::INTEGER)::BIGINT AS n_transitions, round(avg(uncertain), 6) AS uncertain_rate, any_value(l.label) AS majority_cover_label
  FROM moved m JOIN (SELECT orch_id, label, row_number() OVER (PARTITION BY orch_id ORDER BY count(*) DESC, label) AS r FROM asg GROUP BY orch_id, label) l ON l.orch_id = m.orch_id AND l.r = 1 GROUP BY m.orch_id""", "moved"))
def entity_profiles(spark, d):
    return sequences.profiles(P.assigned(spark, d)).withColumn("uncertain_rate", F.round("uncertain_rate", 6))


@query(sql(f"SELECT orch_id, season_sort, {q6('best_soft_norm')}, stratum FROM norm", "norm"))
def robust_minmax_stratum(spark, d):
    return P.wide(spark, d).select(*KEYS, *r6("best_soft_norm"), "stratum")


@query(sql(f"""SELECT season_sort, orch_id, CASE WHEN cluster_role = 'Cover Crops' THEN 'Cover' ELSE 'Bare' END AS cluster_role_mapped, {q6('best_soft_norm')}, best_soft_norm <= 0.15 AS uncertain, coalesce(time_since_last_flip = 0, false) AS flipped_this_season,
  streak_len_current::INTEGER AS streak_len_current, time_since_last_flip, n_periods_used AS npts_total, {q6('env_z_season')}, stratum FROM seq""", "seq"))
def season_attributes(spark, d):
    out = serving.attributes(P.wide(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("best_soft_norm", "env_z_season")})


@query(sql("""SELECT orch_id, season, season_sort, cluster_role, CASE WHEN cluster_role = 'Cover Crops' THEN '#2ca25f' ELSE '#8B4513' END AS cluster_color, round_even(best_soft_norm * 100, 0)::INTEGER AS alpha100, (season_sort + 1) || '-01-31' AS season_mid,
  round(CASE WHEN cluster_role = 'Cover Crops' THEN best_soft ELSE 1 - best_soft END, 6) AS p_cover, round_even(best_soft, 3) AS confidence FROM norm""", "norm"))
def serving_table(spark, d):
    return P.wide(spark, d).select("orch_id", "season", "season_sort", "cluster_role", "cluster_color", "alpha100", "season_mid", *r6("p_cover"), "confidence")


@query(sql("SELECT 1 AS schema_version, array_to_string(list_sort(list(DISTINCT season_sort)), ',') AS years, 0.15::DOUBLE AS ui_uncertain_threshold, 'earliest=bit0' AS bit_order FROM norm", "norm"))
def manifest_row(spark, d):
    return serving.manifest(P.wide(spark, d)).withColumn("years", F.array_join(F.col("years").cast("array<string>"), ","))


# ---------------------------------------------------------------- summaries


@query(sql("SELECT season_sort, count(*) AS n_trends, count_if(Q >= 0.2 AND n_periods_used >= 2)::BIGINT AS n_train, count_if(n_periods_used >= 2)::BIGINT AS n_assigned_all, round_even(100.0::DOUBLE * (count(*) - count_if(Q >= 0.2 AND n_periods_used >= 2)) / count(*), 1) AS lost_pct_train_only, round_even(100.0::DOUBLE * (count(*) - count_if(n_periods_used >= 2)) / count(*), 1) AS lost_pct_after_all FROM qual GROUP BY ALL", "qual"))
def season_coverage(spark, d):
    flagged = P.trended(spark, d).withColumns({"train": (F.col("Q") >= 0.2) & (F.col("n_periods_used") >= 2), "assigned": F.col("n_periods_used") >= 2})
    return analysis.coverage(flagged.drop("season"), "train", "assigned")


_PROFILE = ", ".join(f"round(avg({c}), 6) + 0.0 AS mean_{c}, round(quantile_cont({c}, .25), 6) + 0.0 AS p25_{c}, round(quantile_cont({c}, .75), 6) + 0.0 AS p75_{c}" for c in analysis.PROFILED)


@query(sql(f"SELECT cluster, count(*) AS n, round(avg(f_1), 6) + 0.0 AS centroid_f_1, round(avg(f_2), 6) + 0.0 AS centroid_f_2, round(avg(uncertain), 6) + 0.0 AS uncertain_rate, round(avg(best_soft), 6) AS mean_silhouette, round(avg(Q), 6) + 0.0 AS mean_CMI__Q, {_PROFILE} FROM asg GROUP BY cluster", "asg"))
def cluster_profile(spark, d):
    rows = P.assigned(spark, d).withColumns({"silhouette": F.col("best_soft"), "CMI__Q": F.col("Q")})
    out = analysis.cluster_profiles(rows, ["f_1", "f_2"], analysis.PROFILED)
    return out.select("cluster", "n", *r6(*[c for c in out.columns if c not in ("cluster", "n")]))


@query(sql("""SELECT label, count_if(stratum = 'Old')::BIGINT AS Old, count_if(stratum = 'Young')::BIGINT AS Young, round(100.0::DOUBLE * count_if(stratum = 'Old') / count(*), 6) AS Old_pct, round(100.0::DOUBLE * count_if(stratum = 'Young') / count(*), 6) AS Young_pct FROM strat WHERE stratum IS NOT NULL GROUP BY label""", "strat"))
def crosstab_pct(spark, d):
    joined = P.assigned(spark, d).join(P.ages(spark, d).select("season", "orch_id", "cmi_label"), ["season", "orch_id"], "left")
    out = analysis.crosstab(joined, "label", "cmi_label", ["Old", "Young"])
    return out.select("label", "Old", "Young", *r6("Old_pct", "Young_pct"))


@query(sql("SELECT CASE WHEN grouping(season_sort) = 1 THEN 'GLOBAL' ELSE 'SEASON_' || season_sort END AS scope, count(*) AS n, round(corr(env_z_season, f_1 + 0.8 * f_2), 6) AS corr FROM strat WHERE env_z_season IS NOT NULL GROUP BY GROUPING SETS ((), (season_sort))", "strat"))
def correlation_grouping_sets(spark, d):
    joined = P.assigned(spark, d).join(P.ages(spark, d).select("season", "orch_id", "CMI_z"), ["season", "orch_id"]).withColumn("score", S.cover_score(F.col("f_1"), F.col("f_2")))
    out = analysis.correlations(joined, "CMI_z", "score", "season_sort")
    return out.select("scope", "n", *r6("corr"))


@query("""WITH r AS (SELECT l_returnflag = 'R' AS y, l_linestatus, rank() OVER (PARTITION BY l_linestatus ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_linestatus, l_quantity) - 1) / 2.0::DOUBLE AS ar FROM lineitem)
SELECT l_linestatus, round((sum(ar) FILTER (y) - count_if(y) * (count_if(y) + 1) / 2.0::DOUBLE) / nullif(count_if(y) * count_if(NOT y), 0), 6) AS auc FROM r GROUP BY l_linestatus""")
def rank_auc(spark, d):
    rows = table(spark, d, "lineitem").select("l_linestatus", "l_quantity", (F.col("l_returnflag") == "R").alias("y"))
    return analysis.auc(rows, "l_quantity", "y", ["l_linestatus"]).withColumn("auc", F.round("auc", 6))


@query("""WITH r AS (SELECT l_returnflag = 'R' AS y, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE AS ar FROM lineitem)
SELECT round((sum(ar) FILTER (y) - count_if(y) * (count_if(y) + 1) / 2.0::DOUBLE) / nullif(count_if(y) * count_if(NOT y), 0), 6) AS auc FROM r""")
def rank_auc_global(spark, d):
    rows = table(spark, d, "lineitem").select("l_extendedprice", (F.col("l_returnflag") == "R").alias("y"))
    return analysis.auc(rows, "l_extendedprice", "y").select(F.round("auc", 6).alias("auc"))


@query(sql("""SELECT orch_id, season_sort, round(coalesce(least(1.0, greatest(0.0, z_slope_Fill)), (SELECT median(least(1.0, greatest(0.0, z_slope_Fill))) FROM asg)), 6) + 0.0 AS filled, round((best_soft + 1) / 2, 6) AS by_silhouette,
  round(least(1.0, greatest(0.0, (s - ends[1]) / (ends[2] - ends[1]))), 6) + 0.0 AS by_score FROM (SELECT *, z_slope_Intensity + 0.8 * z_level_Intensity_t5 AS s FROM asg), (SELECT quantile_cont(z_slope_Intensity + 0.8 * z_level_Intensity_t5, [.05, .95]) AS ends FROM asg)""", "asg"))
def softness_branches(spark, d):
    rows = P.assigned(spark, d).select(*KEYS, "z_slope_Intensity", "z_slope_Fill", "z_level_Intensity_t5", F.col("best_soft").alias("soft"))
    filled = clusters.softness(rows.withColumn("best_soft", F.col("z_slope_Fill")))
    both = filled.select(*KEYS, F.col("best_soft").alias("filled")).join(clusters.softness(rows.withColumn("silhouette", F.col("soft"))).select(*KEYS, F.col("best_soft").alias("by_silhouette")), list(KEYS))
    return both.join(clusters.softness(rows).select(*KEYS, F.col("best_soft").alias("by_score")), list(KEYS)).select(*KEYS, *r6("filled", "by_silhouette", "by_score"))


@query("SELECT year(l_shipdate)::INTEGER AS season_sort, l_suppkey, round(median(l_quantity), 6) AS CMI__l_quantity, round(median(l_extendedprice), 6) AS CMI__l_extendedprice FROM lineitem GROUP BY ALL")
def summer_summary_median(spark, d):
    rows = table(spark, d, "lineitem").select(F.year("l_shipdate").alias("season_sort"), "l_suppkey", "l_quantity", "l_extendedprice")
    out = analysis.group_medians(rows, ["season_sort", "l_suppkey"])
    return out.select("season_sort", "l_suppkey", *r6("CMI__l_quantity", "CMI__l_extendedprice"))


@query(sql(f"SELECT a.orch_id, a.season_sort, a.cluster, {q6('CMI_z')}, cmi_label FROM asg a LEFT JOIN age USING (season, orch_id)", "age"))
def age_left_join(spark, d):
    joined = P.assigned(spark, d).join(P.ages(spark, d).select("season", "orch_id", "CMI_z", "cmi_label"), ["season", "orch_id"], "left")
    return joined.select(*KEYS, "cluster", *r6("CMI_z"), "cmi_label")


@query("""WITH q AS (SELECT o_orderpriority AS p, avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders GROUP BY 1)
SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS z FROM orders JOIN q ON p = o_orderpriority""")
def season_zscore(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return robust.season_z(rows, ["o_orderpriority"], "o_totalprice", "z").select("o_orderkey", *r6("z"))


@query("SELECT l_returnflag, round(quantile_cont(l_extendedprice, .25), 6) AS a, round(quantile_cont(l_extendedprice, .5), 6) AS b, round(quantile_cont(l_extendedprice, .9), 6) AS c, round(quantile_cont(l_quantity, .5), 6) AS m FROM lineitem GROUP BY 1")
def bracketed_quantiles(spark, d):
    q = quantiles.bracketed_quantiles(table(spark, d, "lineitem"), ["l_returnflag"], ["l_extendedprice", "l_quantity"], [0.25, 0.5, 0.9])
    e = F.col("l_extendedprice__q")
    return q.select("l_returnflag", F.round(e[0], 6).alias("a"), F.round(e[1], 6).alias("b"), F.round(e[2], 6).alias("c"), F.round(F.col("l_quantity__q")[1], 6).alias("m"))


@query(sql("""SELECT orch_id, season_sort, CASE WHEN b IS NULL THEN NULL WHEN a IS NULL THEN 0 ELSE round((b - a) / greatest(a, b), 6) END AS silhouette FROM (SELECT x.orch_id, x.season_sort,
  avg(sqrt((x.f_1 - y.f_1) ^ 2 + (x.f_2 - y.f_2) ^ 2)) FILTER (x.cluster = y.cluster) AS a, avg(sqrt((x.f_1 - y.f_1) ^ 2 + (x.f_2 - y.f_2) ^ 2)) FILTER (x.cluster <> y.cluster) AS b
  FROM asg x JOIN asg y ON x.season_sort = y.season_sort AND x.orch_id <> y.orch_id GROUP BY 1, 2)""", "asg"))
def season_silhouette(spark, d):
    rows = P.assigned(spark, d).select(*KEYS, "cluster", "f_1", "f_2")
    return clusters.silhouette(rows, "orch_id", ["f_1", "f_2"], "cluster", ["season_sort"]).select(*KEYS, *r6("silhouette"))


# ---------------------------------------------------------------- images and pixels


@query("""SELECT o_orderkey, event_id, round(value, 6) AS value FROM orders JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) e ON e.user_id = o_custkey AND r = 1""")
def first_match_join(spark, d):
    images = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    clouds = table(spark, d, "events").select("user_id", "event_id", "value")
    return pixels.first_match(images, clouds, "user_id", "event_id").select("o_orderkey", "event_id", *r6("value"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE NOT (o_totalprice / 5000 > 40 OR l_extendedprice < 3000) GROUP BY 1")
def cloud_mask(spark, d):
    joined = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice").join(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_totalprice"), "l_orderkey")
    return joined.where(S.clear_pixel(F.col("o_totalprice") / F.lit(5000.0), F.col("l_extendedprice"))).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


_WINDOWS = [(i, f"2024-01-{1 + 3 * (i - 1):02}", f"2024-01-{1 + 3 * (i - 1) + 5:02}") for i in range(1, 9)]
_WINDOW_SQL = "(VALUES " + ", ".join(f"({i}, DATE '{s}', DATE '{e}')" for i, s, e in _WINDOWS) + ") w(time_period, s, e)"


def _windows(spark) -> DataFrame:
    return spark.createDataFrame(_WINDOWS, "time_period int, start string, end string").select("time_period", F.to_date("start").alias("start"), F.to_date("end").alias("end"))


@query(f"SELECT event_id, time_period FROM events JOIN {_WINDOW_SQL} ON ts >= s AND ts < e")
def interval_window_join(spark, d):
    return pixels.in_windows(table(spark, d, "events").select("event_id", "ts"), "ts", _windows(spark)).select("event_id", "time_period")


@query(f"SELECT time_period, count(event_id) AS n FROM {_WINDOW_SQL} LEFT JOIN events e ON ts >= s AND ts < w.e GROUP BY 1")
def images_per_window(spark, d):
    return pixels.images_per_window(table(spark, d, "events").select("ts"), "ts", _windows(spark))


def _order_windows(spark, d) -> DataFrame:
    """A window an order, of up to two hours, that begins in the minute which its key and price say; a third of the orders share a status."""
    o = table(spark, d, "orders")
    minute = F.pmod(F.col("o_orderkey") * F.lit(7919) + F.floor("o_totalprice"), F.lit(43_200))
    start = F.unix_micros(F.lit("2024-01-01").cast("timestamp")) + minute * F.lit(60_000_000)
    length = (F.pmod(F.col("o_orderkey"), F.lit(120)) + F.lit(1)) * F.lit(60_000_000)
    return o.select("o_orderkey", (F.col("o_custkey") % 5).alias("kind"), F.timestamp_micros(start).cast("timestamp_ntz").alias("start"), F.timestamp_micros(start + length).cast("timestamp_ntz").alias("end"))


_ORDER_WINDOWS = "(SELECT o_orderkey, o_custkey % 5 AS kind, s, s + to_minutes(o_orderkey % 120 + 1) AS e FROM (SELECT *, TIMESTAMP '2024-01-01' + to_minutes(((o_orderkey * 7919 + floor(o_totalprice)::BIGINT) % 43200)::BIGINT) AS s FROM orders)) w"


@query(f"SELECT event_id, o_orderkey FROM events JOIN {_ORDER_WINDOWS} ON ts >= s AND ts < w.e AND user_id % 5 = kind")
def bucketed_interval_join(spark, d):
    """Every event with all order windows of its kind that hold it: thousands of overlapping windows a key."""
    events = table(spark, d, "events").select("event_id", "ts", (F.col("user_id") % 5).alias("kind"))
    return intervals.interval_join(events, "ts", _order_windows(spark, d), ["kind"]).select("event_id", "o_orderkey")


#: An outline with a bay, and the hole in it, about a polygon's middle; the unit is the polygon's size.
_OUTLINE = ((1, 0), (0.5, 0.9), (0.1, 0.3), (-0.4, 0.8), (-1, 0.1), (-0.6, -0.7), (0.2, -1), (0.7, -0.5))
_HOLE = ((0.1, 0.1), (0.3, -0.2), (-0.2, -0.3))


def _supplier_polygons(spark, d) -> DataFrame:
    s = table(spark, d, "supplier")
    x, y, size = F.col("s_nationkey") * F.lit(2.0) + F.lit(1.0), (F.col("s_acctbal") + F.lit(1000.0)) / F.lit(110.0), (F.col("s_suppkey") % 7 + F.lit(2)).cast("double")
    ring = lambda shape: F.array(*[F.array(x + size * F.lit(float(a)), y + size * F.lit(float(b))) for a, b in (*shape, shape[0])])
    return s.select("s_suppkey", F.array(ring(_OUTLINE), ring(_HOLE)).alias("rings"))


def _line_points(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") + F.col("l_tax") * F.lit(10.0)).alias("px"), (F.col("l_extendedprice") / F.lit(1000.0)).alias("py"), "l_discount")


_EDGE_VALUES = ", ".join(f"({a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for shape in (_OUTLINE, _HOLE) for a, b in zip(shape, (*shape[1:], shape[0])))
_IN_POLYGON = f"""poly AS (SELECT s_suppkey, s_nationkey * 2.0::DOUBLE + 1 AS cx, (s_acctbal + 1000) / 110 AS cy, (s_suppkey % 7 + 2)::DOUBLE AS size FROM supplier),
edge AS (SELECT s_suppkey, CASE WHEN ay <= b_y THEN ax ELSE bx END AS x1, least(ay, b_y) AS y1, CASE WHEN ay <= b_y THEN bx ELSE ax END AS x2, greatest(ay, b_y) AS y2
  FROM (SELECT s_suppkey, cx + size * a AS ax, cy + size * b AS ay, cx + size * c AS bx, cy + size * e AS b_y FROM poly, (VALUES {_EDGE_VALUES}) v(a, b, c, e))),
pt AS (SELECT row_number() OVER () AS line, l_orderkey, l_linenumber, l_discount, l_quantity + l_tax * 10 AS px, l_extendedprice / 1000 AS py FROM lineitem),
held AS (SELECT any_value(l_orderkey) AS l_orderkey, any_value(l_linenumber) AS l_linenumber, any_value(l_discount) AS l_discount, s_suppkey FROM pt JOIN edge ON y1 <= py AND y2 > py AND px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 GROUP BY line, s_suppkey HAVING count(*) % 2 = 1)"""


@query(f"WITH {_IN_POLYGON} SELECT l_orderkey, l_linenumber, s_suppkey FROM held")
def points_in_polygons(spark, d):
    """Every line's point with the suppliers' polygons, each with a bay and a hole, that hold it."""
    points = _line_points(spark, d).select("l_orderkey", "l_linenumber", "px", "py")
    return spatial.points_in_polygons(points, "px", "py", _supplier_polygons(spark, d), "s_suppkey").select("l_orderkey", "l_linenumber", "s_suppkey")


@query(f"WITH {_IN_POLYGON} SELECT s_suppkey, round(avg(l_discount), 6) AS mean, round(median(l_discount), 6) AS median, round(stddev_pop(l_discount), 6) AS sd FROM held GROUP BY 1")
def polygon_zonal_stats(spark, d):
    return spatial.reduce_regions(_line_points(spark, d), "px", "py", "l_discount", _supplier_polygons(spark, d), "s_suppkey").select("s_suppkey", *r6("mean", "median", "sd"))


_REGION = (((3, 10), (40, 20), (25, 80), (20, 30), (5, 60)), ((20, 20), (22, 26), (30, 22)))
_REGION_EDGES = "(VALUES " + ", ".join(f"({a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for ring in _REGION for a, b in zip(ring, (*ring[1:], ring[0]))) + ") r(ax, ay, bx, b_y)"
_SIDE = lambda a, b, c, e, x, y: f"(({c} - {a}) * ({y} - {b}) - ({e} - {b}) * ({x} - {a}))"


@query(f"""WITH box AS (SELECT o_orderkey, (o_custkey % 97)::DOUBLE / 2 AS x, o_totalprice / 4000 AS y, (o_orderkey % 5 + 1)::DOUBLE AS size FROM orders),
side AS (SELECT o_orderkey, x + size * a AS px, y + size * b AS py, x + size * c AS qx, y + size * e AS qy FROM box, (VALUES (0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0)) v(a, b, c, e)),
border AS (SELECT DISTINCT o_orderkey FROM side, {_REGION_EDGES} WHERE greatest(px, qx) >= least(ax, bx) AND greatest(ax, bx) >= least(px, qx) AND greatest(py, qy) >= least(ay, b_y) AND greatest(ay, b_y) >= least(py, qy)
  AND {_SIDE("px", "py", "qx", "qy", "ax", "ay")} * {_SIDE("px", "py", "qx", "qy", "bx", "b_y")} <= 0 AND {_SIDE("ax", "ay", "bx", "b_y", "px", "py")} * {_SIDE("ax", "ay", "bx", "b_y", "qx", "qy")} <= 0),
held AS (SELECT o_orderkey FROM box, {_REGION_EDGES} WHERE least(ay, b_y) <= y AND greatest(ay, b_y) > y AND x < (bx - ax) * (y - ay) / (b_y - ay) + ax GROUP BY 1 HAVING count(*) % 2 = 1)
SELECT o_orderkey FROM border UNION SELECT o_orderkey FROM held UNION SELECT o_orderkey FROM box WHERE x <= {_REGION[0][0][0]} AND {_REGION[0][0][0]} < x + size AND y <= {_REGION[0][0][1]} AND {_REGION[0][0][1]} < y + size""")
def filter_bounds(spark, d):
    """The orders whose square footprint meets a region with a hole."""
    x, y, size = (F.col("o_custkey") % 97).cast("double") / F.lit(2.0), F.col("o_totalprice") / F.lit(4000.0), (F.col("o_orderkey") % 5 + F.lit(1)).cast("double")
    ring = F.array(*[F.array(x + size * F.lit(float(a)), y + size * F.lit(float(b))) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))])
    return table(spark, d, "orders").where(spatial.intersects(F.array(ring), _REGION)).select("o_orderkey")


@query(f"""WITH m AS (SELECT user_id, time_period, avg(value) AS mean FROM events JOIN {_WINDOW_SQL} ON ts >= s AND ts < e GROUP BY ALL)
SELECT z.user_id, w.time_period, round(coalesce(mean, 0), 6) AS mean FROM (SELECT DISTINCT user_id FROM events) z CROSS JOIN {_WINDOW_SQL} LEFT JOIN m ON m.user_id = z.user_id AND m.time_period = w.time_period""")
def zone_window_cross(spark, d):
    events = table(spark, d, "events").select("user_id", "ts", "value")
    measured = pixels.in_windows(events, "ts", _windows(spark)).groupBy("user_id", "time_period").agg(F.avg("value").alias("mean"))
    out = pixels.zone_windows(events.select("user_id").distinct(), _windows(spark), measured, ["user_id", "time_period"])
    return out.select("user_id", "time_period", *r6("mean"))


@query("SELECT l_partkey, l_suppkey, count(l_extendedprice) AS n_obs, CASE WHEN count(l_extendedprice) >= 3 THEN round(quantile_cont(l_extendedprice, .9), 6) END AS p90, round(median(l_extendedprice), 6) AS median FROM lineitem GROUP BY 1, 2")
def pixel_composites(spark, d):
    out = pixels.composites(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], "l_extendedprice")
    return out.select("l_partkey", "l_suppkey", "n_obs", *r6("p90", "median"))


@query("SELECT l_suppkey, round(avg(l_quantity), 6) AS mean, round(median(l_quantity), 6) AS median, round(stddev_pop(l_quantity), 6) AS sd FROM lineitem GROUP BY 1")
def zonal_stats(spark, d):
    return pixels.zonal(table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity").select("l_suppkey", *r6("mean", "median", "sd"))


@query("""SELECT l_orderkey, l_linenumber, round(2.5 * (n - r) / nullif(n + 2.4 * r + 1, 0), 6) AS evi2, round(1.5 * (l_quantity - l_tax) / nullif(l_quantity + l_tax + 0.5, 0), 6) AS savi, round(((l_quantity + l_tax) - (l_discount + 1)) / nullif((l_quantity + l_tax) + (l_discount + 1), 0), 6) AS bsi
FROM (SELECT *, l_extendedprice / 10000 AS n, l_quantity / 10000 AS r FROM lineitem)""")
def vegetation_indices(spark, d):
    q, t = F.col("l_quantity"), F.col("l_tax")
    out = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.evi2(F.col("l_extendedprice"), q).alias("evi2"), S.savi(q, t).alias("savi"), S.bsi(q, t, F.col("l_discount"), F.lit(1.0)).alias("bsi"))
    return out.select("l_orderkey", "l_linenumber", *r6("evi2", "savi", "bsi"))


@query("""SELECT l_suppkey, count(*) AS n, round(avg((1.5 * ((l_discount * 10 - l_tax) / nullif(l_discount * 10 + l_tax + 0.5, 0)) > 0.3)::INTEGER), 6) AS green,
  round(avg(((l_quantity - 25) / nullif(l_quantity + 25, 0) < 0.1)::INTEGER), 6) AS covered FROM lineitem GROUP BY 1""")
def fill_fractions(spark, d):
    q = F.col("l_quantity")
    rows = table(spark, d, "lineitem").select("l_suppkey", S.savi_fill(S.savi(F.col("l_discount") * F.lit(10.0), F.col("l_tax"))).alias("g"), S.bsi_fill(S.bsi(q, F.lit(0.0), F.lit(25.0), F.lit(0.0))).alias("c"))
    out = rows.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.avg("g").alias("green"), F.avg("c").alias("covered"))
    return out.select("l_suppkey", "n", *r6("green", "covered"))


@query("SELECT p_partkey, ((p_size % 4 = 1)::INTEGER + (p_size % 3 = 1)::INTEGER + (p_size % 2 = 1)::INTEGER) AS stability_score FROM part WHERE stability_score >= 2")
def stability_score(spark, d):
    yearly = table(spark, d, "part").select("p_partkey", *[(F.when(F.col("p_size") % k != 0, F.col("p_size") % k)).alias(f"CDL{k}") for k in (4, 3, 2)])
    return yearly.select("p_partkey", pixels.stability(yearly, ["CDL4", "CDL3", "CDL2"], 1).alias("stability_score")).where("stability_score >= 2")


@query("SELECT l_suppkey, l_returnflag AS dominant FROM (SELECT l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_returnflag) AS r FROM lineitem GROUP BY 1, 2) WHERE r = 1")
def dominant_crop(spark, d):
    return analysis.dominant(table(spark, d, "lineitem").select("l_suppkey", "l_returnflag"), ["l_suppkey"], "l_returnflag", "dominant")


@query("SELECT s_suppkey::VARCHAR AS orch_id, n_name AS county, CASE WHEN s_suppkey % 2 = 0 THEN '75' ELSE '69' END AS dominant_crop, '69' AS current_crop, (s_suppkey % 9)::DOUBLE AS stability_score, round(s_acctbal, 6) AS acres FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def tile_properties(spark, d):
    s = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("n_nationkey") == F.col("s_nationkey"))
    even = F.col("s_suppkey") % 2 == 0
    crops = {f"CROP{y}": F.when(even & (F.lit(y) < 23), 75).when(~even & (F.lit(y) < 18), 75).otherwise(69) for y in range(16, 24)}
    polygons = s.withColumns(crops).select(F.col("s_suppkey").alias("orch_id"), F.col("n_name").alias("CNTY"), (F.col("s_suppkey") % 9).alias("stability_score"), F.col("s_acctbal").alias("ACRES"), *crops)
    return serving.require_keys(serving.tile_properties(polygons), "orch_id").withColumn("acres", F.round("acres", 6))


@query("SELECT s_nationkey, round(100.0::DOUBLE * count_if(s_suppkey % 3 = 0) / count(*), 6) AS pct_count, round(100.0::DOUBLE * sum(CASE WHEN s_suppkey % 3 = 0 THEN abs(s_acctbal) ELSE 0 END) / sum(abs(s_acctbal)), 6) AS pct_acres FROM supplier GROUP BY 1")
def cover_share(spark, d):
    rows = table(spark, d, "supplier").select("s_nationkey", (F.col("s_suppkey") % 3 == 0).alias("cover"), F.abs("s_acctbal").alias("acres"))
    return analysis.cover_share(rows, ["s_nationkey"], "cover", "acres").select("s_nationkey", *r6("pct_count", "pct_acres"))


@query("SELECT round(min(s_acctbal), 6) AS min_x, min(s_suppkey) AS min_y, round(max(s_acctbal), 6) AS max_x, max(s_suppkey) AS max_y FROM supplier WHERE s_nationkey BETWEEN 3 AND 20 AND s_acctbal BETWEEN -500 AND 9000")
def bounding_box(spark, d):
    inside = table(spark, d, "supplier").where(pixels.within_box(F.col("s_nationkey"), F.col("s_acctbal"), (3, -500, 20, 9000)))
    return analysis.bounds(inside, "s_acctbal", "s_suppkey").select(*r6("min_x"), "min_y", *r6("max_x"), "max_y")


@query("""WITH q AS (SELECT s_suppkey, s_acctbal, s_nationkey::DOUBLE - 110 AS x, s_acctbal / 200 AS y FROM supplier),
area AS (SELECT s_suppkey, abs(sum(radians(bx - ax) * (2 + sin(radians(ay)) + sin(radians(by_))))) * 6378137.0::DOUBLE ^ 2 / 2 / 4046.8564224 AS acres FROM (
  SELECT s_suppkey, x + a AS ax, y + b AS ay, x + c AS bx, y + e AS by_ FROM q, (VALUES (0, 0, 0.01, 0), (0.01, 0, 0.01, 0.02), (0.01, 0.02, 0, 0.01), (0, 0.01, 0, 0)) s(a, b, c, e)) GROUP BY 1)
SELECT c_custkey, s_suppkey::VARCHAR AS orch_id, round(CASE WHEN s_acctbal > 2000 THEN s_acctbal ELSE acres END, 4) AS acres, round(x + 0.005, 6) AS cx, round(y + 0.0075, 6) AS cy
FROM customer LEFT JOIN q ON s_suppkey = c_nationkey + 1 LEFT JOIN area USING (s_suppkey)""")
def acres_lookup(spark, d):
    x, y = F.col("s_nationkey").cast("double") - F.lit(110.0), F.col("s_acctbal") / F.lit(200.0)
    ring = F.array(*[F.array(x + F.lit(float(a)), y + F.lit(float(b))) for a, b in ((0, 0), (0.01, 0), (0.01, 0.02), (0, 0.01), (0, 0))])
    polygons = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("orch_id"), F.when(F.col("s_acctbal") > 2000, F.col("s_acctbal")).otherwise(0.0).alias("acres"), ring.alias("ring"))
    rows = table(spark, d, "customer").select("c_custkey", (F.col("c_nationkey") + 1).cast("string").alias("orch_id"))
    out = serving.with_acres(rows, polygons)
    known = F.when(F.col("acres").isNotNull(), F.col("orch_id"))
    return out.select("c_custkey", known.alias("orch_id"), F.round("acres", 4).alias("acres"), F.round(F.col("centroid")[0], 6).alias("cx"), F.round(F.col("centroid")[1], 6).alias("cy"))


@query("SELECT l_orderkey, l_linenumber, round(CASE WHEN x <= 0 THEN 0.2 WHEN x < 5 THEN 0.2 + x / 5 * 0.5 WHEN x < 8 THEN 0.7 + (x - 5) / 3 * 0.3 ELSE 1.0 END, 6) AS opacity FROM (SELECT *, l_discount * 100 - 1 AS x FROM lineitem)")
def opacity_stops(spark, d):
    x = F.col("l_discount") * F.lit(100.0) - F.lit(1.0)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(S.between_stops(x, [(0, 0.2), (5, 0.7), (8, 1.0)]), 6).alias("opacity"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_tax = 0 THEN -9999.0 ELSE l_tax END AS tax FROM lineitem")
def zero_as_missing(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.missing_if_zero(F.col("l_tax"), -9999.0).alias("tax"))


@query("""SELECT o_orderkey FROM (SELECT *, year(o_orderdate) + 22 AS y, strftime(o_orderdate, '%m-%d') AS md FROM orders)
WHERE CASE WHEN y <= 2018 THEN md >= '05-15' AND md < '11-15' ELSE md >= '06-15' AND md < '10-15' END""")
def summer_images(spark, d):
    later = F.add_months(F.to_date("o_orderdate"), 22 * 12)
    return table(spark, d, "orders").where(pixels.in_summer(later)).select("o_orderkey")


@query("SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def head_report(spark, d):
    return analysis.head(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 20).select("o_orderkey", *r6("o_totalprice"))


# ---------------------------------------------------------------- keys, labels, documents


@query("""SELECT o_orderkey, season, year(o_orderdate)::INTEGER AS season_sort, CASE WHEN o_orderkey % 3 = 0 THEN year(o_orderdate) || '-01-31' ELSE (year(o_orderdate) + 1) || '-01-31' END AS season_mid
FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN year(o_orderdate)::VARCHAR ELSE year(o_orderdate) || '_' || (year(o_orderdate) + 1) END AS season FROM orders)""")
def season_keys(spark, d):
    y = F.year("o_orderdate")
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, y.cast("string")).otherwise(P.season(y)).alias("season"))
    return rows.select("o_orderkey", "season", S.season_sort(F.col("season")).alias("season_sort"), S.season_mid(F.col("season")).alias("season_mid"))


@query("""WITH l AS (SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN ' Cover ' WHEN 1 THEN 'LIKELY COVER CROPPING' WHEN 2 THEN 'Mixed' WHEN 3 THEN 'Likely Baseline' END AS label FROM customer)
SELECT c_custkey, CASE WHEN lower(trim(label)) IN ('cover', 'likely cover cropping') THEN 'Cover Crops' WHEN lower(trim(label)) IN ('baseline', 'mixed') THEN 'Mixed' ELSE 'Bare Soil' END AS role,
  CASE WHEN lower(trim(label)) IN ('cover', 'likely cover cropping') THEN '#2ca25f' WHEN lower(trim(label)) IN ('baseline', 'mixed') THEN '#6a51a3' ELSE '#8B4513' END AS colour FROM l""")
def role_colours(spark, d):
    k = F.col("c_nationkey") % 5
    label = F.when(k == 0, " Cover ").when(k == 1, "LIKELY COVER CROPPING").when(k == 2, "Mixed").when(k == 3, "Likely Baseline")
    role = S.role_of(label)
    return table(spark, d, "customer").select("c_custkey", role.alias("role"), S.colour_of(role).alias("colour"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN x <= 0.15 THEN 'Coin Toss' WHEN x <= 0.35 THEN 'Low' WHEN x <= 0.65 THEN 'Average' WHEN x <= 0.85 THEN 'Good' ELSE 'High' END AS bucket, x <= 0.15 AS uncertain FROM (SELECT *, l_discount * 10 AS x FROM lineitem)")
def confidence_buckets(spark, d):
    x = F.col("l_discount") * F.lit(10.0)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.confidence_bucket(x).alias("bucket"), (F.coalesce(x, F.lit(0.0)) <= 0.15).alias("uncertain"))


@query("""SELECT page_id, coalesce(list_filter(list_transform(regexp_extract_all(path, '(20\\d{2})', 1), lambda y: y::INTEGER), lambda y: y BETWEEN 2010 AND 2035)[1], 0) AS season
FROM (SELECT page_id, 'x/' || (1990 + page_id % 60) || '_' || (2000 + page_id % 40) || '.csv' AS path FROM pages)""")
def filename_season(spark, d):
    k = F.col("page_id")
    path = F.concat(F.lit("x/"), (F.lit(1990) + k % 60).cast("string"), F.lit("_"), (F.lit(2000) + k % 40).cast("string"), F.lit(".csv"))
    return table(spark, d, "pages").select("page_id", S.season_from_path(path).alias("season"))


@query("SELECT event_type AS folder, event_id::VARCHAR AS file, j.key AS orch_id, j.value::VARCHAR AS value FROM events, json_each(props) j")
def json_parse(spark, d):
    files = table(spark, d, "events").select(F.col("event_type").alias("folder"), F.col("event_id").cast("string").alias("file"), F.col("props").cast("binary").alias("content"))
    return merging.entries(files)


@query("""WITH c AS (SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN ' True' WHEN 1 THEN 'false' WHEN 2 THEN ' ' WHEN 3 THEN round(c_acctbal, 0)::BIGINT || '.0' ELSE 'x' END AS cell FROM customer)
SELECT c_custkey, CASE WHEN trim(cell) <> '' THEN lower(trim(cell)) = 'true' END AS b, try_cast(nullif(trim(cell), '') AS DOUBLE)::INTEGER AS i, try_cast(nullif(trim(cell), '') AS DOUBLE) AS f FROM c""")
def typed_cells(spark, d):
    k = F.col("c_nationkey") % 5
    cell = F.when(k == 0, " True").when(k == 1, "false").when(k == 2, " ").when(k == 3, F.concat(F.round("c_acctbal", 0).cast("long").cast("string"), F.lit(".0"))).otherwise("x")
    return table(spark, d, "customer").select("c_custkey", S.typed(cell, "bool").alias("b"), S.typed(cell, "int").alias("i"), S.typed(cell, "double").alias("f"))


@query("SELECT source, lang, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lang, doc_id % 50 ORDER BY source DESC, doc_id DESC) AS r FROM documents) WHERE r = 1")
def upsert_merge(spark, d):
    rows = table(spark, d, "documents").select("source", "lang", "doc_id", "n_chars", (F.col("doc_id") % 50).alias("k"), F.struct("source", "doc_id").alias("o"))
    return merging.upsert(rows, ["lang", "k"], "o").select("source", "lang", "doc_id", "n_chars")


def _files(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(F.col("source").alias("folder"), F.col("doc_id").cast("string").alias("file"), F.md5("text").alias("hash"), F.col("text").cast("binary").alias("content"), "lang")


@query("SELECT source AS folder, doc_id::VARCHAR AS file, md5(text) AS hash FROM documents WHERE lang IS DISTINCT FROM 'en'")
def incremental_anti_join(spark, d):
    files = _files(spark, d)
    state = merging.next_state(spark.createDataFrame([], "folder string, file string, hash string"), files.where("lang = 'en'"))
    return merging.changed_files(files, state).select("folder", "file", "hash")


@query("SELECT array_to_string(list_sort(list_distinct(flatten(list([y, y + 1, y + 2])))), ',') AS years, min_by(y, n) AS first_year FROM (SELECT n_name AS n, (1990 + n_nationkey) AS y FROM nation)")
def manifest_years_union(spark, d):
    y = (F.lit(1990) + F.col("n_nationkey")).cast("int")
    rows = table(spark, d, "nation").select(F.col("n_name").alias("folder"), F.array(y, y + 1, y + 2).alias("years"), y.alias("first_year"))
    return merging.merged_manifest(rows).withColumn("years", F.array_join(F.col("years").cast("array<string>"), ","))


@query("SELECT o_orderpriority AS file, count(*) AS orchards, count(DISTINCT o_orderstatus) AS n_sources, round_even(sum(o_orderkey) / 1024.0::DOUBLE, 1) AS size_kb FROM orders GROUP BY 1")
def merge_report(spark, d):
    return merging.merge_report(table(spark, d, "orders").select(F.col("o_orderpriority").alias("file"), F.col("o_orderstatus").alias("folder"), F.col("o_orderkey").alias("bytes")))


@query("SELECT s_suppkey AS k, s_acctbal AS v, 's' AS src, NULL::VARCHAR AS seg FROM supplier UNION ALL SELECT c_custkey, c_acctbal, 'c', c_mktsegment FROM customer")
def union_by_name(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"), F.lit("s").alias("src"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), F.lit("c").alias("src"), F.col("c_mktsegment").alias("seg"))
    return s.unionByName(c, allowMissingColumns=True)


@query("SELECT year, count(o_orderkey) AS n FROM (SELECT unnest(range(1993, 2004))::INTEGER AS year) LEFT JOIN orders ON year(o_orderdate) = year GROUP BY 1")
def year_sequence(spark, d):
    counts = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("o_orderkey").alias("n"))
    return readers.years(spark, 1993, 2003).join(counts, "year", "left").fillna(0, ["n"])


@query("""WITH e AS (SELECT o_orderstatus AS folder, year(o_orderdate) || '.json' AS file, o_custkey::VARCHAR AS orch_id, max(o_orderkey)::VARCHAR AS value FROM orders GROUP BY ALL)
SELECT folder, file, orch_id, value FROM e WHERE folder <> 'F' QUALIFY row_number() OVER (PARTITION BY file, orch_id ORDER BY folder DESC) = 1""")
def merged_documents(spark, d):
    rows = _order_entries(spark, d)
    changed = rows.where("folder <> 'F'")
    # what the last run knew of the changed folders' files goes, and F's files are theirs no more
    old = changed.withColumn("value", F.lit("old"))
    return merging.merge_onto(old, changed, ["file", "orch_id"]).select("folder", "file", "orch_id", "value")


def _order_entries(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_orderstatus").alias("folder"), F.concat(F.year("o_orderdate").cast("string"), F.lit(".json")).alias("file"), F.col("o_custkey").cast("string").alias("orch_id")).agg(F.max("o_orderkey").cast("string").alias("value"))


@query("""WITH e AS (SELECT o_orderstatus AS folder, year(o_orderdate) || '.json' AS file, o_custkey::VARCHAR AS orch_id, max(o_orderkey)::VARCHAR AS value FROM orders GROUP BY ALL),
per AS (SELECT file, count(*) AS n, round_even(sum(length(orch_id) + length(value) + 4) / 1024.0::DOUBLE, 1) AS kb FROM e GROUP BY 1)
SELECT round_even(sum(kb), 1) AS total_size_kb, max(n) AS most_orchards, string_agg(file[1:4], ',' ORDER BY file) AS years, (SELECT string_agg(DISTINCT folder, ',' ORDER BY folder) FROM e) AS folders, (SELECT count(*) FROM (SELECT DISTINCT folder, file FROM e)) AS n_files FROM per""")
def merge_totals(spark, d):
    rows = checkpointed(_order_entries(spark, d))
    out = merging.run_report(rows, rows)
    return out.select("total_size_kb", "most_orchards", F.array_join(F.col("years").cast("array<string>"), ",").alias("years"), F.array_join("folders", ",").alias("folders"), "n_files")


_J = lambda name, value: f"'\"{name}\":' || coalesce({value}, 'null')"
_ENTRY = " || ',' || ".join([_J("cluster_role_mapped", "'\"' || CASE WHEN cluster_role = 'Cover Crops' THEN 'Cover' ELSE 'Bare' END || '\"'"), _J("uncertain", "(best_soft_norm <= 0.15)::VARCHAR"), _J("flipped_this_season", "coalesce(time_since_last_flip = 0, false)::VARCHAR"), _J("streak_len_current", "streak_len_current::VARCHAR"), _J("npts_total", "n_periods_used::VARCHAR"), _J("stratum", "'\"' || stratum || '\"'")])


@query(sql(f"SELECT season_sort, orch_id, '\"' || orch_id || '\":{{' || {_ENTRY} || '}}' AS entry FROM seq", "seq"))
def keyed_json_doc(spark, d):
    """One entry a row: the document of a season is its entries between braces."""
    rows = serving.attributes(P.wide(spark, d)).drop("best_soft_norm", "time_since_last_flip", "env_z_season")
    return writers.keyed_entries(rows, "orch_id", ["season_sort"])


# ---------------------------------------------------------------- fits: SQL goes on from given centres to the same fixed point


def _lloyd_sql(columns: list[str], starts: list[list[float]], source: str, upto: str, out: str, rounds: int = 40) -> str:
    """Rounds of k-means from given centres, over the steps of the panel."""
    centres = "c0 AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {', '.join(f'{x}::DOUBLE' for x in c)})" for i, c in enumerate(starts)) + f") v(k, {', '.join(f'm{i}' for i in range(len(columns)))}))"
    square = " + ".join(f"({c} - m{i}) ^ 2" for i, c in enumerate(columns))
    steps = [f"c{r} AS MATERIALIZED (SELECT k, {', '.join(f'avg({c}) AS m{i}' for i, c in enumerate(columns))} FROM (SELECT {', '.join(f'any_value({c}) AS {c}' for c in columns)}, arg_min(k, {square}) AS k FROM kpts, c{r - 1} GROUP BY id) GROUP BY k)" for r in range(1, rounds + 1)]
    whole = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    body = f"kpts AS MATERIALIZED (SELECT row_number() OVER () AS id, {', '.join(columns)} FROM {source} WHERE {whole}), {centres}, " + ", ".join(steps)
    return sql(out.format(last=f"c{rounds}"), upto).replace("\n" + out.format(last=f"c{rounds}"), ", " + body + "\n" + out.format(last=f"c{rounds}"))


@query(_lloyd_sql(["f_1", "f_2"], P.CENTERS, "asg", "asg", "SELECT CASE WHEN k = arg_max_k THEN 'Likely Cover Cropping' ELSE 'Likely Not Cover Cropping' END AS label, round(m0, 4) + 0.0 AS f_1, round(m1, 4) + 0.0 AS f_2 FROM {last}, (SELECT arg_max(k, m0 + 0.8 * m1) AS arg_max_k FROM {last})"))
def kmeans_fit(spark, d):
    model = clusters.kmeans(P.assigned(spark, d).select("f_1", "f_2"), ["f_1", "f_2"], 2)
    labels = clusters.label_map(model.centers)
    return spark.createDataFrame([(labels[i], *c) for i, c in enumerate(model.centers)], "label string, f_1 double, f_2 double").select("label", *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("f_1", "f_2")])


@query(sql("""SELECT unnest(['Young', 'Old']) AS cmi_label, unnest([round(s / i, 4) + 0.0, round((t - s) / (n - i), 4) + 0.0]) AS center FROM (
  SELECT *, s * s / i + (t - s) * (t - s) / (n - i) AS kept FROM (SELECT row_number() OVER w AS i, sum(CMI_z) OVER w AS s, sum(CMI_z) OVER () AS t, count(*) OVER () AS n FROM age WINDOW w AS (ORDER BY CMI_z ROWS UNBOUNDED PRECEDING)) WHERE i < n)
QUALIFY row_number() OVER (ORDER BY kept DESC, i) <= 1""", "age"))
def age_fit(spark, d):
    model = clusters.kmeans(P.ages(spark, d).select("CMI_z"), ["CMI_z"], 2)
    names = clusters.age_labels([c[0] for c in model.centers])
    return spark.createDataFrame([(names[i], c[0]) for i, c in enumerate(model.centers)], "cmi_label string, center double").select("cmi_label", (F.round("center", 4) + F.lit(0.0)).alias("center"))


@query(sql("""SELECT cmi_label, round(avg(CASE WHEN b IS NULL THEN NULL WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM (SELECT x.orch_id, x.season_sort, x.cmi_label,
  avg(abs(x.CMI_z - y.CMI_z)) FILTER (x.cmi_label = y.cmi_label) AS a, avg(abs(x.CMI_z - y.CMI_z)) FILTER (x.cmi_label <> y.cmi_label) AS b
  FROM age x JOIN age y ON x.orch_id <> y.orch_id OR x.season_sort <> y.season_sort GROUP BY ALL) GROUP BY 1""", "age"))
def age_silhouette(spark, d):
    rows = P.ages(spark, d).select(F.concat_ws("/", "season", "orch_id").alias("k"), "CMI_z", "cmi_cluster", "cmi_label")
    each = clusters.silhouette(rows, "k", ["CMI_z"], "cmi_cluster").select("k", "silhouette")
    return rows.join(each, "k").groupBy("cmi_label").agg(F.round(F.avg("silhouette"), 6).alias("silhouette"))


_MIXTURE = clusters.Model(2, P.CENTERS, 0.0, [[0.8, 1.1], [0.5, 0.9]], [0.4, 0.6])
_LOG = lambda i: f"ln({_MIXTURE.weights[i]}) - 0.5 * (" + " + ".join(f"(f_{j + 1} - {m}) * (f_{j + 1} - {m}) / {v} + ln(2 * pi() * {v})" for j, (m, v) in enumerate(zip(_MIXTURE.centers[i], _MIXTURE.variances[i]))).replace("- -", "+ ") + ")"


@query(sql(f"""SELECT orch_id, season_sort, CASE WHEN p >= 0.5 THEN 0 ELSE 1 END AS cluster, round(greatest(p, 1 - p), 6) AS best_soft, (greatest(p, 1 - p) < 0.6)::INTEGER AS uncertain, round(p, 6) AS p_0, round(likely, 6) AS log_likelihood FROM (
  SELECT *, exp(a - greatest(a, b)) / (exp(a - greatest(a, b)) + exp(b - greatest(a, b))) AS p, greatest(a, b) + ln(exp(a - greatest(a, b)) + exp(b - greatest(a, b))) AS likely FROM (SELECT *, {_LOG(0)} AS a, {_LOG(1)} AS b FROM asg))""", "asg"))
def mixture_posteriors(spark, d):
    """Every row's probabilities under a given mixture, its cluster by them, and its log-likelihood."""
    rows = P.assigned(spark, d).select(*KEYS, "f_1", "f_2")
    p, likely = clusters.posteriors(["f_1", "f_2"], _MIXTURE)
    out = clusters.mixture_assign(rows.withColumns({"p_0": p[0], "log_likelihood": likely}), ["f_1", "f_2"], _MIXTURE)
    return out.select(*KEYS, "cluster", F.round("best_soft", 6).alias("best_soft"), "uncertain", F.round("p_0", 6).alias("p_0"), F.round("log_likelihood", 6).alias("log_likelihood"))


# ---------------------------------------------------------------- without SQL: choices and fits


@query()
def kmeans_choice(spark, d):
    choice = clusters.choose_k(P.assigned(spark, d).select("f_1", "f_2"), ["f_1", "f_2"], (2, 3))
    labels = clusters.label_map(choice.model.centers)
    return spark.createDataFrame([(labels[i], *c, choice.score(choice.model.k)) for i, c in enumerate(choice.model.centers)], "label string, f_1 double, f_2 double, silhouette double")


@query()
def mixture_choice(spark, d):
    choice = clusters.choose_k(P.assigned(spark, d).select("f_1", "f_2"), ["f_1", "f_2"], (2, 3), "bic")
    return spark.createDataFrame([(i, *c, choice.score(choice.model.k)) for i, c in enumerate(choice.model.centers)], "cluster int, f_1 double, f_2 double, bic double")


@query()
def age_cluster_choice(spark, d):
    choice = clusters.choose_k(P.ages(spark, d).select("CMI_z"), ["CMI_z"], (2, 3))
    centers = [c[0] for c in choice.model.centers]
    return spark.createDataFrame([(name, centers[i], choice.score(choice.model.k)) for i, name in clusters.age_labels(centers).items()], "cmi_label string, center double, silhouette double")


def _newton_sql(rounds: int = 14, folds: int = 5) -> str:
    """Stratified folds and penalised regressions of every scope by Newton's method from zero, then areas by ranks."""
    start = f"""x0 AS (SELECT season || '/' || orch_id AS k, season_sort, CMI_z AS x, (label = 'Likely Cover Cropping')::INTEGER AS y FROM asg JOIN age USING (season, season_sort, orch_id)),
sc AS (SELECT unnest(['GLOBAL', 'SEASON_' || season_sort]) AS scope, k, x, y FROM x0),
fo AS MATERIALIZED (SELECT *, (row_number() OVER (PARTITION BY scope ORDER BY y, md5(k)) - 1) % {folds} AS fold FROM sc),
tr AS MATERIALIZED (SELECT scope, m, x, y FROM fo, (SELECT unnest(range({folds})) AS m) WHERE fold <> m),
p0 AS (SELECT DISTINCT scope, m, 0.0::DOUBLE AS w, 0.0::DOUBLE AS b FROM tr)"""
    steps = [f"""p{r} AS MATERIALIZED (SELECT scope, m, w + (hbw * gb - hbb * gw) / (hbb * hww - hbw * hbw) AS w, b + (hbw * gw - hww * gb) / (hbb * hww - hbw * hbw) AS b FROM (
  SELECT scope, m, any_value(w) AS w, any_value(b) AS b, sum(p - y) AS gb, sum((p - y) * x) + any_value(w) AS gw, sum(p * (1 - p)) AS hbb, sum(p * (1 - p) * x) AS hbw, sum(p * (1 - p) * x * x) + 1 AS hww
  FROM (SELECT *, 1 / (1 + exp(-(w * x + b))) AS p FROM tr JOIN p{r - 1} USING (scope, m)) GROUP BY scope, m))""" for r in range(1, rounds + 1)]  # fmt: skip
    out = f"""SELECT scope, round((sum(ar) FILTER (y = 1) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0::DOUBLE) / nullif(count_if(y = 1) * count_if(y = 0), 0), 6) AS auc FROM (
  SELECT *, rank() OVER (PARTITION BY scope ORDER BY s) + (count(*) OVER (PARTITION BY scope, s) - 1) / 2.0::DOUBLE AS ar FROM (SELECT scope, y, 1 / (1 + exp(-(w * x + b))) AS s FROM fo JOIN p{rounds} USING (scope) WHERE m = fold AND scope IN (SELECT scope FROM fit))) GROUP BY scope"""
    # a scope is fitted if the rows outside each fold are of both classes, and one class has a row for each fold
    steps.append(f"fit AS (SELECT scope FROM (SELECT scope, m, min(y) < max(y) AS both_there FROM tr GROUP BY ALL) GROUP BY scope HAVING bool_and(both_there) INTERSECT SELECT scope FROM fo GROUP BY scope HAVING greatest(sum(y), count(*) - sum(y)) >= {folds})")
    return sql(out, "age").replace("\n" + out, ",\n" + ",\n".join([start, *steps]) + "\n" + out)


@query(_newton_sql())
def cross_validated_auc(spark, d):
    """Areas of all seasons and of each, by regressions that are fitted side by side."""
    joined = P.assigned(spark, d).join(P.ages(spark, d).select("season", "orch_id", "CMI_z"), ["season", "orch_id"])
    rows = checkpointed(joined.select("season_sort", F.concat_ws("/", "season", "orch_id").alias("k"), "CMI_z", (F.col("label") == "Likely Cover Cropping").alias("cover")))
    return R.cross_validated_areas(rows, "k", "CMI_z", "cover").select("scope", F.round("auc", 6).alias("auc"))


def _run_inputs(spark, d) -> tuple[DataFrame, DataFrame]:
    """The panel as winter rows, and quantities as the summer index."""
    winter = P.panel(spark, d).withColumns({"season": P.season(F.col("season_sort")), **{old: F.col(new) for old, new in R.MEASURES.items()}})
    summer = table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("orch_id"), P.season(F.year("l_shipdate")).alias("season"), F.year("l_shipdate").alias("season_sort"), F.col("l_quantity").alias("EVI2_p90_summer_mean"))
    return checkpointed(winter), summer


@query()
def whole_run(spark, d):
    """The run's attributes, with everything fitted on the panel itself."""
    tables, _ = R.analyse(*_run_inputs(spark, d))
    return tables["attrs"]


@query(sql(f"SELECT season, season_sort, orch_id, {q6('f_1', 'f_2', 'Q', 'best_soft')}, cluster, uncertain, label, round(v, 6) AS CMI FROM asg LEFT JOIN idx USING (season_sort, orch_id)", "idx"))
def templated_run(spark, d):
    """A whole run's assignments by a template that was fitted before."""
    template = R.Template("kmeans", "cover2", clusters.Model(2, P.CENTERS, 0.0), clusters.label_map(P.CENTERS), "sqrt", False, 0.2, 0.0, 2, 0.6, 1.5, P.SETTINGS.trend_periods)
    tables, _ = R.analyse(*_run_inputs(spark, d), P.SETTINGS, R.Template.from_json(template.as_json()))
    return tables["assign_all"].select("season", "season_sort", "orch_id", *r6("f_1", "f_2", "Q", "best_soft"), "cluster", "uncertain", "label", F.round("CMI", 6).alias("CMI"))
