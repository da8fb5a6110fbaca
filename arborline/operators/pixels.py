"""Image and pixel tables: cloud joins, masks, window joins, composites and zonal statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborline.config import WINTER_WINDOWS
from arborline.functions.quantiles import exact_quantiles
from arborline.functions.running import totals_below


def winter_windows(spark, start_year: int) -> DataFrame:
    """(time_period, start, end) of a winter as dates, end exclusive; months before November are the next year's."""
    day = lambda md: f"{start_year + (int(md[:2]) < 11)}-{md}"
    rows = [(p, day(s), day(e)) for p, s, e in WINTER_WINDOWS]
    return spark.createDataFrame(rows, "time_period int, start string, end string").select("time_period", F.to_date("start").alias("start"), F.to_date("end").alias("end"))


def in_summer(day: Column) -> Column:
    """Whether a date lies in its year's summer window: from 15 May to before 15 November up to 2018, then from 15 June to before 15 October."""
    at = F.date_format(day, "MM-dd")
    return F.when(F.year(day) <= 2018, (at >= "05-15") & (at < "11-15")).otherwise((at >= "06-15") & (at < "10-15"))


def first_match(images: DataFrame, clouds: DataFrame, key: str, order: str) -> DataFrame:
    """Images with the first of their matches in clouds; images without one go."""
    first = Window.partitionBy(key).orderBy(order)
    one = clouds.withColumn("r__", F.row_number().over(first)).where("r__ = 1").drop("r__")
    return images.join(one, key)


def in_windows(rows: DataFrame, time: str, windows: DataFrame) -> DataFrame:
    """A row for each window [start, end) that holds its time; windows overlap, and are a handful, so they are broadcast."""
    return rows.join(F.broadcast(windows), (F.col(time) >= F.col("start")) & (F.col(time) < F.col("end")))


def composites(pixels: DataFrame, keys: Sequence[str], value: str, least: int = 3) -> DataFrame:
    """Per pixel: observations, the 90th percentile (null below ``least`` observations) and the median."""
    n = F.count(value)
    return pixels.groupBy(*keys).agg(n.alias("n_obs"), F.when(n >= least, F.percentile(value, F.lit(0.9))).alias("p90"), F.median(value).alias("median"))


def zonal(pixels: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per zone, of any size: mean, median and population deviation."""
    moments = pixels.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))
    middle = exact_quantiles(pixels.select(*keys, value), keys, [value], (0.5,)).select(*[F.col(k).alias(f"{k}__k") for k in keys], F.col(f"{value}__q")[0].alias("median"))
    on = F.lit(True)
    for k in keys:
        on = on & moments[k].eqNullSafe(middle[f"{k}__k"])
    return moments.join(middle, on).select(*keys, "mean", "median", "sd")


def zonal_counts(counts: DataFrame, key: str, value: str, n: str) -> DataFrame:
    """As zonal on one key, of rows that stand for n equal ones each; counts is checkpointed, with a row a key and value. Medians come of running totals, so zones may be of any size."""
    known = counts.where(F.col(value).isNotNull()).select(F.col(key).alias("zone__"), F.col(value).cast("double").alias("v"), F.col(n).alias("n"))
    means = known.groupBy(F.col("zone__").alias("mean__k")).agg(F.sum("n").alias("all"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"))
    away = F.col("v") - F.col("mean")
    spread = known.join(means, F.col("zone__").eqNullSafe(F.col("mean__k"))).groupBy(F.col("zone__").alias("sd__k")).agg(F.sqrt(F.sum(F.col("n") * away * away) / F.first("all")).alias("sd"))
    placed = totals_below(known, ["zone__"], "v", ["n"]).join(means, F.col("zone__").eqNullSafe(F.col("mean__k")))
    rank = (F.col("all") - F.lit(1)) / F.lit(2.0)
    at = lambda r: F.max(F.when((F.col("n__below") <= r) & (r < F.col("n__below") + F.col("n")), F.col("v")))
    middle = placed.groupBy(F.col("zone__").alias("middle__k")).agg(at(F.floor(rank)).alias("a"), at(F.ceil(rank)).alias("b"), F.first("mean").alias("mean"))
    zones = counts.select(F.col(key).alias("zone__")).distinct()
    out = zones.join(middle, F.col("zone__").eqNullSafe(F.col("middle__k")), "left").join(spread, F.col("zone__").eqNullSafe(F.col("sd__k")), "left")
    return out.select(F.col("zone__").alias(key), "mean", (F.col("a") + (F.col("b") - F.col("a")) / F.lit(2.0)).alias("median"), "sd")


def zone_windows(zones: DataFrame, windows: DataFrame, measured: DataFrame, keys: Sequence[str], default: float = 0.0) -> DataFrame:
    """Every zone in every window with its measures; a window without imagery gets the default, as exports write it."""
    values = [c for c in measured.columns if c not in keys]
    return zones.crossJoin(F.broadcast(windows)).join(measured, list(keys), "left").fillna(default, values)


def images_per_window(images: DataFrame, time: str, windows: DataFrame) -> DataFrame:
    """How many images each window has, windows without any included."""
    counts = in_windows(images, time, windows).groupBy("time_period").agg(F.count(F.lit(1)).alias("n"))
    return windows.select("time_period").join(counts, "time_period", "left").fillna(0, ["n"])


def stability(df: DataFrame, yearly: Sequence[str], crop: int) -> Column:
    """In how many of the yearly columns the crop is ``crop``; nulls count as none."""
    total = F.lit(0)
    for c in yearly:
        total = total + F.coalesce((F.col(c) == crop).cast("int"), F.lit(0))
    return total


def within_box(x: Column, y: Column, box: tuple[float, float, float, float]) -> Column:
    return x.between(box[0], box[2]) & y.between(box[1], box[3])
