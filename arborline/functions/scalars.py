"""Column expressions of the analytics. Nulls stand for missing values and stay null unless said otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from arborline.config import EPS

num = lambda x: F.lit(float(x))


def clamp(x: Column, low: float, high: float) -> Column:
    """x held between low and high; least and greatest alone would skip a null."""
    return F.when(x.isNotNull(), F.least(num(high), F.greatest(num(low), x)))


def clip01(x: Column) -> Column:
    return clamp(x, 0, 1)


def null_if_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def high_tail01(u: Column) -> Column:
    return clip01((u - num(0.5)) / num(0.3))


def period_weight(t: Column) -> Column:
    """From 0.3 at the second window and before to 0.7 at the seventh and after."""
    return num(0.3) + num(0.4) * (clamp(t.cast("double"), 2, 7) - num(2)) / num(5)


def intensity(t: Column, savi: Column, bsi_green: Column) -> Column:
    w = period_weight(t)
    return w * savi + (num(1) - w) * bsi_green


def fill_reward(savi: Column, bsi_green: Column) -> Column:
    return num(0.5) * high_tail01(savi) + num(0.5) * high_tail01(bsi_green)


def variation(mean: Column, sd: Column) -> Column:
    return sd / (F.abs(mean) + num(EPS))


def row_is_missing(*measures: Column) -> Column:
    """All measures are about 0, as exports write missing windows; a null measure makes no missing row."""
    out = F.lit(True)
    for m in measures:
        out = out & F.coalesce(F.abs(m) <= num(EPS), F.lit(False))
    return out


def row_weight(valid_fraction: Column, savi_sd: Column, bsi_sd: Column, use_fraction: bool = True) -> Column:
    """The valid pixel fraction where it is above 0, else the inverse of the two deviations."""
    noise = num(1) / (savi_sd + bsi_sd + num(EPS))
    return F.when(valid_fraction > 0, valid_fraction).otherwise(noise) if use_fraction else noise


def shrink_factor(r2: Column, mode: str) -> Column:
    """How far a feature of fit r2 is kept; r2 is held to 0..1 first."""
    r = clip01(r2)
    if mode == "none":
        return num(1)
    if mode == "sqrt":
        return F.sqrt(r)
    if mode == "linear":
        return clip01((r - num(0.2)) / num(0.6))
    if mode == "logistic":
        return num(1) / (num(1) + F.exp(-(r - num(0.5)) / num(0.1)))
    raise ValueError(f"unknown shrink mode {mode!r}")


def mean_of(*columns: Column) -> Column:
    """The mean of the values that are there; null if none is."""
    total, n = num(0), F.lit(0)
    for c in columns:
        total, n = total + F.coalesce(c, num(0)), n + c.isNotNull().cast("int")
    return F.when(n > 0, total / n)


def season_sort(season: Column) -> Column:
    """The first year of ``2018_2019``; a plain whole number is itself; else null."""
    text = season.cast("string")
    return F.coalesce(F.split(text, "_")[0].try_cast("int"), text.try_cast("int"))


def season_mid(season: Column, month_day: str = "-01-31") -> Column:
    """A date text in the middle of the season: of its second year, or else of the first four digits in it."""
    text = season.cast("string")
    second = F.regexp_extract(text, r"^\d+_(\d{4})$", 1)
    digits = F.substring(F.regexp_replace(text, "[^0-9]", ""), 1, 4)
    return F.when(second != "", F.concat(second, F.lit(month_day))).when(F.length(digits) == 4, F.concat(digits, F.lit(month_day)))


def season_from_path(path: Column) -> Column:
    """The first year from 2010 to 2035 that the path names; 0 if none."""
    years = F.filter(F.transform(F.regexp_extract_all(path, F.lit(r"(20\d{2})"), F.lit(1)), lambda y: y.cast("int")), lambda y: y.between(2010, 2035))
    return F.coalesce(F.try_element_at(years, F.lit(1)), F.lit(0))


#: Which labels mean which role, and the roles' colours; fixed values.
ROLES = {"Cover Crops": ("cover", "likely cover cropping"), "Mixed": ("baseline", "mixed")}
COLOURS = {"Cover Crops": "#2ca25f", "Mixed": "#6a51a3", "Bare Soil": "#8B4513"}


def role_of(label: Column) -> Column:
    """The role of a cluster label, whatever its case; what is not known is bare soil."""
    plain = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    out = F.when(plain.isin(*ROLES["Cover Crops"]), "Cover Crops").when(plain.isin(*ROLES["Mixed"]), "Mixed")
    return out.otherwise("Bare Soil")


def colour_of(role: Column) -> Column:
    out = F.lit("#9ca3af")
    for name, colour in COLOURS.items():
        out = F.when(role == name, colour).otherwise(out)
    return out


def confidence_bucket(x: Column) -> Column:
    """Names of right-closed ranges; null counts as 0."""
    v = F.coalesce(x, num(0))
    return F.when(v <= 0.15, "Coin Toss").when(v <= 0.35, "Low").when(v <= 0.65, "Average").when(v <= 0.85, "Good").otherwise("High")


def flip_magnitude(distance: Column) -> Column:
    return F.when(distance >= 1.25, "Large").when(distance < 0.75, "Small").otherwise("Medium")


def alpha100(x: Column) -> Column:
    return F.bround(clip01(x) * num(100), 0).cast("int")


def distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Euclidean distance over the dimensions both have, scaled up for those missing; null if there is none."""
    square, n = num(0), F.lit(0)
    for x, y in zip(a, b):
        d = (x - y).cast("double")
        square, n = square + F.coalesce(d * d, num(0)), n + d.isNotNull().cast("int")
    return F.when(n > 0, F.sqrt(square) * F.sqrt(num(len(a)) / n))


def soft_confidence(d1: Column, d2: Column) -> Column:
    return num(1) - F.try_divide(d1, d1 + d2)


def cover_score(slope: Column, level: Column) -> Column:
    return slope + num(0.8) * level


def evi2(nir: Column, red: Column) -> Column:
    n, r = nir / num(10000), red / num(10000)
    return num(2.5) * F.try_divide(n - r, n + num(2.4) * r + num(1))


def savi(nir: Column, red: Column) -> Column:
    return num(1.5) * F.try_divide(nir - red, nir + red + num(0.5))


def bsi(swir: Column, red: Column, nir: Column, blue: Column) -> Column:
    return F.try_divide((swir + red) - (nir + blue), (swir + red) + (nir + blue))


def savi_fill(index: Column) -> Column:
    """1 for a green pixel, 0 for another; null stays null."""
    return (index > num(0.3)).cast("double")


def bsi_fill(index: Column) -> Column:
    """1 for a pixel that is not bare, 0 for another; null stays null."""
    return (index < num(0.1)).cast("double")


def clear_pixel(cloud: Column, nir: Column, most_cloud: float = 40, least_nir: float = 3000) -> Column:
    """Neither cloudy nor dark in the near infrared."""
    return ~((cloud > most_cloud) | (nir < least_nir))


def ring_area(ring: Column) -> Column:
    """Square metres of a ring of [longitude, latitude] pairs on a sphere of radius 6378137 m, its sign dropped."""
    n = F.size(ring)
    at = lambda i: F.element_at(ring, i)
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.struct(at(i).alias("a"), at(F.least(i + 1, n)).alias("b")))
    part = lambda p: F.radians(p["b"][0] - p["a"][0]) * (num(2) + F.sin(F.radians(p["a"][1])) + F.sin(F.radians(p["b"][1])))
    return F.abs(F.aggregate(pairs, num(0), lambda s, p: s + part(p))) * num(6378137.0**2 / 2)


def typed(value: Column, kind: str) -> Column:
    """A text cell as bool, int (through a double) or double; an empty cell is null."""
    v = F.when(F.trim(value) != "", F.trim(value))
    if kind == "bool":
        return F.lower(v) == "true"
    return v.try_cast("double").cast("int") if kind == "int" else v.try_cast(kind)


def ring_centroid(ring: Column) -> Column:
    """[x, y] of the mean of a ring's points, the closing one left out; null for an empty ring."""
    n = F.size(ring)
    closed = (n > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1))
    points = F.slice(ring, F.lit(1), F.when(closed, n - 1).otherwise(n))
    mean = lambda i: F.aggregate(points, num(0), lambda s, p: s + F.element_at(p, i)) / F.size(points)
    return F.when(n > 0, F.array(mean(1), mean(2)))


def acres_or_area(acres: Column, ring: Column) -> Column:
    """The acres on record, or where they are missing or 0 those of the ring."""
    return F.coalesce(F.nullif(acres, num(0)), ring_area(ring) / num(4046.8564224))


def between_stops(x: Column, stops: Sequence[tuple[float, float]]) -> Column:
    """Linear interpolation between (input, output) stops, in rising order of input; constant beyond the ends, null for null."""
    out = num(stops[-1][1])
    for (a, low), (b, high) in reversed(list(zip(stops, stops[1:]))):
        out = F.when(x < b, num(low) + (x - num(a)) / num(b - a) * num(high - low)).otherwise(out)
    return F.when(x.isNotNull(), F.when(x <= stops[0][0], num(stops[0][1])).otherwise(out))


def missing_if_zero(x: Column, instead: float) -> Column:
    """What exports write: the value, or ``instead`` where it is null or 0 (a true 0 counts as missing there)."""
    return F.coalesce(F.nullif(x, num(0)), num(instead))
