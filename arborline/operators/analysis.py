"""Summaries: coverage, cluster profiles, crosstabs, correlations and areas under the curve."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed
from arborline.functions.quantiles import exact_quantiles
from arborline.functions.running import same_keys, totals_below
from arborline.functions.scalars import num


def group_medians(df: DataFrame, keys: Sequence[str], prefix: str = "CMI__") -> DataFrame:
    """The median of every numeric column by keys, under prefixed names; rows with a null key are left out."""
    columns = [f.name for f in df.schema if f.name not in keys and f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte")]
    found = exact_quantiles(df.dropna(subset=list(keys)).select(*keys, *columns), keys, columns, (0.5,))
    return found.select(*keys, *[F.col(f"{c}__q")[0].alias(prefix + c) for c in columns])


def index_column(columns: Sequence[str], wanted: str | None = None) -> str | None:
    """The summer index among a lookup's columns: the wanted one, with or without its prefix; else one named season_z, else the first CMI__ one; or none."""
    if wanted is not None:
        return next((c for c in (wanted, f"CMI__{wanted}") if c in columns), None)
    found = [c for c in columns if c.startswith("CMI__")]
    return next((c for c in found if "season_z" in c.lower()), found[0] if found else None)


def coverage(trends: DataFrame, train: str, assigned: str) -> DataFrame:
    """Per season (season_sort, and season if it is there): rows, rows trained on and assigned (flag columns), and the percentages lost, to one place, half to even."""
    out = trends.groupBy(*[c for c in ("season", "season_sort") if c in trends.columns]).agg(F.count(F.lit(1)).alias("n_trends"), F.count_if(train).alias("n_train"), F.count_if(assigned).alias("n_assigned_all"))
    lost = lambda n: F.bround(num(100) * (F.col("n_trends") - F.col(n)) / F.greatest("n_trends", F.lit(1)), 1)
    return out.withColumns({"lost_pct_train_only": lost("n_train"), "lost_pct_after_all": lost("n_assigned_all")})


#: Columns of trends that cluster profiles describe, as far as they are there; fixed value.
PROFILED = ("slope_Intensity", "slope_Fill", "slope_Uniformity", "r2_Intensity", "r2_Fill", "r2_Uniformity", "z_slope_Intensity", "z_slope_Fill", "z_slope_Uniformity", "z_level_Intensity_t5")


def cluster_profiles(df: DataFrame, features: Sequence[str], columns: Sequence[str], silhouettes: DataFrame | None = None) -> DataFrame:
    """Per cluster: rows, mean features, uncertain rate and silhouette (df's column, or of ``silhouettes`` (cluster, silhouette), which only the result reads); mean and quartiles of columns, means of CMI__ columns."""
    parts = [F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"centroid_{f}") for f in features], F.avg("uncertain").alias("uncertain_rate")]
    if silhouettes is None and "silhouette" in df.columns:
        parts.append(F.avg("silhouette").alias("mean_silhouette"))
    described = [F.avg(c).alias(f"mean_{c}") for c in [*columns, *(c for c in df.columns if c.startswith("CMI__"))]]
    means = df.groupBy("cluster").agg(*parts, *described)
    quarters = exact_quantiles(df, ["cluster"], columns, (0.25, 0.75)).withColumnRenamed("cluster", "cluster__k")
    ends = [f for c in columns for f in (F.col(f"{c}__q")[0].alias(f"p25_{c}"), F.col(f"{c}__q")[1].alias(f"p75_{c}"))]
    shown = list(means.columns)
    if silhouettes is not None:
        own = silhouettes.groupBy(F.col("cluster").alias("cluster__s")).agg(F.avg("silhouette").alias("mean_silhouette"))
        means = means.join(own, means["cluster"].eqNullSafe(own["cluster__s"]), "left").drop("cluster__s")
        shown.insert(len(parts) + 1, "mean_silhouette")
    return means.join(quarters, means["cluster"].eqNullSafe(quarters["cluster__k"]), "left").select(*shown, *ends)


#: Columns that a crosstab can get.
MOST_VALUES = 1000


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts of each pair, and <value>_pct: their percentages of the row. Rows with a null in either are left out.

    values: the column's values; without them they are looked up, which more than MOST_VALUES refuse.
    """
    whole = df.dropna(subset=[row, column])
    if values is None:
        values = sorted(r[0] for r in whole.select(column).distinct().limit(MOST_VALUES + 1).collect())
        if len(values) > MOST_VALUES:
            raise ValueError(f"{column} has more than {MOST_VALUES} values")
    values = list(values)
    counts = whole.groupBy(row).pivot(column, values).count().fillna(0, values)
    total = sum((F.col(f"`{v}`") for v in values[1:]), F.col(f"`{values[0]}`")) if values else F.lit(0)
    return counts.select(row, *[F.col(f"`{v}`") for v in values], *[F.try_divide(F.col(f"`{v}`") * num(100), total).alias(f"{v}_pct") for v in values])


def correlations(df: DataFrame, a: str, b: str, by: str) -> DataFrame:
    """(scope, n, corr): GLOBAL and each SEASON_<by>; null where any value is missing."""
    gap = F.count_if(F.col(a).isNull() | F.col(b).isNull())
    out = df.groupingSets([[], [F.col(by)]], by).agg(F.grouping(by).alias("g"), F.count(F.lit(1)).alias("n"), F.when(gap == 0, F.corr(a, b)).alias("corr"))
    return out.select(F.when(F.col("g") == 1, "GLOBAL").otherwise(F.concat(F.lit("SEASON_"), F.col(by).cast("string"))).alias("scope"), "n", "corr")


def auc(df: DataFrame, score: str, positive: str, keys: Sequence[str] = ()) -> DataFrame:
    """The area under the ROC curve by ranks, ties at their mean rank; null unless both classes are there.

    Scores are counted by value first, so that equal scores cost one row, and negatives below a score are run up by ranges.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(positive).isNotNull())
    counts = rows.groupBy(*keys, score).agg(F.count_if(positive).alias("p"), F.count_if(~F.col(positive)).alias("q"))
    won = F.col("p") * (F.col("q__below") + F.col("q") / num(2))
    sums = totals_below(counts, keys, score, ["q"]).withColumn("won", won).groupBy(*keys).agg(F.sum("won").alias("won"), F.sum("p").alias("np"), F.sum("q").alias("nq"))
    return sums.select(*keys, F.try_divide(F.col("won"), (F.col("np") * F.col("nq")).cast("double")).alias("auc"))


#: Newton steps of regressions at most, and steps below which they have settled.
MOST_STEPS, SETTLED = 100, 1e-10


def dealt_folds(rows: DataFrame, key: str, folds: int, scopes: Sequence[str] = ()) -> DataFrame:
    """Add fold: rows (key, y) of each scope are ranked by class and the key's hash, and dealt in turn, so that folds have equally many rows of each class within one."""
    ranked = rows.withColumns({"order__": F.struct("y", F.md5(F.col(key).cast("string"))), "one__": F.lit(1).cast("long")})
    return totals_below(ranked, scopes, "order__", ["one__"]).withColumn("fold", F.pmod("one____below", F.lit(folds)).cast("int")).drop("order__", "one__", "one____below")


def _next_step(m: int, penalty: float) -> dict[str, Column]:
    """The columns of model m after a round: the trial if it is no worse than the best so far, with a Newton step from there; else half the last step."""
    c = lambda name: F.col(f"{name}{m}")
    loss = c("loss") + num(penalty / 2) * c("w") * c("w")
    better = loss <= c("best") + F.abs(c("best")) * num(1e-13)
    gw, hww = c("gw") + num(penalty) * c("w"), c("hww") + num(penalty)
    spread = F.greatest(c("hbb") * hww - c("hbw") * c("hbw"), num(1e-300))
    steps = {"w": (c("hbw") * c("gb") - c("hbb") * gw) / spread, "b": (c("hbw") * gw - hww * c("gb")) / spread}
    fits = (c("pos") > 0) & (c("pos") < c("n"))
    out = {f"best{m}": F.when(better, loss).otherwise(c("best")), f"fits{m}": fits}
    for v in "wb":
        step = F.when(~fits, num(0)).when(better, steps[v]).otherwise(c(f"s{v}") / num(2))
        kept = F.when(better, c(v)).otherwise(c(f"p{v}"))
        out |= {f"p{v}{m}": kept, f"s{v}{m}": step, f"{v}{m}": kept + step}
    return out


def fold_models(dealt: DataFrame, folds: int, scopes: Sequence[str] = (), penalty: float = 1.0) -> DataFrame:
    """One row a scope: its mean x, and the logistic regressions w<m> * (x - mean) + b<m> fitted on the rows (x, y, fold) of all folds but m.

    The penalty is on w alone. All models of all scopes go through Newton's method side by side: a round is one aggregation over the rows, whose
    result, some sums a scope, becomes the next table of models; the driver learns the longest step only. fits<m> says whether both classes were there.
    """
    names = {k: f"{k}__k" for k in scopes}
    means = dealt.groupBy(*scopes).agg(F.avg("x").alias("mean")).select(*[F.col(k).alias(n) for k, n in names.items()], "mean")
    models = checkpointed(means.withColumns({f"{c}{m}": num(math.inf if c == "best" else 0) for m in range(folds) for c in ("w", "b", "pw", "pb", "sw", "sb", "best")}))
    kept = [*names.values(), "mean", *(f"{c}{m}" for m in range(folds) for c in ("w", "b", "pw", "pb", "sw", "sb", "best", "fits"))]
    for _ in range(MOST_STEPS):
        both = dealt.join(models, same_keys(dealt, models, names))
        parts = []
        for m in range(folds):
            x = F.col("x") - F.col("mean")
            z = F.col(f"w{m}") * x + F.col(f"b{m}")
            p = num(1) / (num(1) + F.exp(-z))
            terms = {
                "gb": p - F.col("y"), "gw": (p - F.col("y")) * x, "hbb": p * (num(1) - p), "hbw": p * (num(1) - p) * x, "hww": p * (num(1) - p) * x * x,
                "loss": F.greatest(z, num(0)) + F.log1p(F.exp(-F.abs(z))) - F.col("y") * z, "n": num(1), "pos": F.col("y"),
            }
            parts += [F.coalesce(F.sum(F.when(F.col("fold") != m, t)), num(0)).alias(f"{c}{m}") for c, t in terms.items()]
        sums = both.groupBy(*scopes).agg(*parts).withColumnsRenamed({k: f"{k}__s" for k in scopes})
        joined = models.drop(*(f"fits{m}" for m in range(folds))).join(sums, same_keys(models, sums, {n: f"{k}__s" for k, n in names.items()}))
        steps: dict[str, Column] = {}
        for m in range(folds):
            steps |= _next_step(m, penalty)
        models = checkpointed(joined.withColumns(steps).select(*kept))
        longest = F.greatest(*[F.greatest(F.abs(f"sw{m}"), F.abs(f"sb{m}")) / (num(1) + F.abs(f"pw{m}") + F.abs(f"pb{m}")) for m in range(folds)], num(0))
        if (models.agg(F.max(longest)).first()[0] or 0.0) < SETTLED:
            return models.withColumnsRenamed({n: k for k, n in names.items()}).select(*scopes, "mean", *(F.col(f"{c}{m}") for m in range(folds) for c in ("w", "b", "fits")))
    raise RuntimeError("regressions did not settle")


def cross_validated_scores(df: DataFrame, key: str, feature: str, positive: str, folds: int = 5, scopes: Sequence[str] = ()) -> DataFrame:
    """(scopes, key, positive, score): each row's probability under a logistic regression fitted on the scope's other folds, which are stratified.

    A scope has no scores if the rows outside one of its folds are of one class, or if neither class has a row for each fold. Rows with a null feature or class are left out.
    """
    rows = df.where(F.col(feature).isNotNull() & F.col(positive).isNotNull()).select(*scopes, F.col(key), F.col(feature).cast("double").alias("x"), F.col(positive).cast("double").alias("y"))
    dealt = checkpointed(dealt_folds(rows, key, folds, scopes))
    models = fold_models(dealt, folds, scopes).withColumnsRenamed({k: f"{k}__m" for k in scopes})
    counts = dealt.groupBy(*scopes).agg(F.greatest(F.sum("y"), F.sum(num(1) - F.col("y"))).alias("larger__")).withColumnsRenamed({k: f"{k}__c" for k in scopes})
    fits = F.col("larger__") >= folds
    for m in range(folds):
        fits = fits & F.col(f"fits{m}")
    known = models.join(counts, same_keys(models, counts, {f"{k}__m": f"{k}__c" for k in scopes})).where(fits)
    both = dealt.join(known, same_keys(dealt, known, {k: f"{k}__m" for k in scopes}))
    own = lambda c: F.element_at(F.array(*[F.col(f"{c}{m}") for m in range(folds)]), F.col("fold") + F.lit(1))
    score = num(1) / (num(1) + F.exp(-(own("w") * (F.col("x") - F.col("mean")) + own("b"))))
    return both.select(*[dealt[k] for k in scopes], dealt[key], (F.col("y") > 0).alias(positive), score.alias("score"))


def cover_share(df: DataFrame, keys: Sequence[str], cover: str, acres: str) -> DataFrame:
    """Percentages of cover by count and by acres."""
    yes = F.col(cover)
    return df.groupBy(*keys).agg((num(100) * F.count_if(yes) / F.count(F.lit(1))).alias("pct_count"), F.try_divide(num(100) * F.sum(F.when(yes, F.col(acres)).otherwise(0)), F.sum(acres)).alias("pct_acres"))


def dominant(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """The commonest value of each group, nulls counted too; ties go to the smallest, null first."""
    best = Window.partitionBy(*keys).orderBy(F.desc("n__"), F.asc_nulls_first(value))
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n__"))
    return counts.withColumn("r__", F.row_number().over(best)).where("r__ = 1").select(*keys, F.col(value).alias(out))


def bounds(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.min(x).alias("min_x"), F.min(y).alias("min_y"), F.max(x).alias("max_x"), F.max(y).alias("max_y"))


def head(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows in an order, as a report shows them."""
    return df.orderBy(*order).limit(n)
