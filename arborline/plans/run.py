"""A whole run: from winter and summer files to every table that is kept or served, and from served files of many folders to merged documents."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed
from arborline.config import Settings
from arborline.functions.scalars import num
from arborline.operators import analysis, clusters, merging, sequences, serving, trends
from arborline.operators.clusters import Model
from arborline.operators.robust import robust_z
from arborline.sources import documents, readers, writers

KEYS = ("season", "season_sort", "orch_id")
#: Names of the winter export's columns here.
MEASURES = {"orchard_savi_mean": "savi_mean", "orchard_savi_stddev": "savi_sd", "orchard_bsi_mean": "bsi_mean", "orchard_bsi_stddev": "bsi_sd"}
#: Tables that are written only if they have rows.
OPTIONAL = ("cmi_assign", "cmi_centroids", "cmi_metrics", "crosstab")


@dataclass(frozen=True)
class Template:
    """A frozen model with all that is needed to assign further trends by it."""

    method: str
    feature_set: str
    model: Model
    label_map: dict[int, str] | None
    shrink: str
    shrink_level: bool
    min_quality: float
    assign_min_quality: float
    min_periods: int
    confidence_threshold: float
    distance_threshold: float
    periods: tuple[int, ...]

    @property
    def columns(self) -> list[str]:
        return [f"f_{i}" for i in range(1, len(trends.FEATURE_SETS[self.feature_set]) + 1)]

    def as_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Template:
        d = json.loads(text)
        labels = d["label_map"] and {int(k): v for k, v in d["label_map"].items()}
        return Template(**{**d, "model": Model(**d["model"]), "label_map": labels, "periods": tuple(d["periods"])})


def panel_of(winter: DataFrame) -> DataFrame:
    """Winter rows under the names of the analytics; rows without a period, which no window holds, go."""
    valid = F.col("valid_pixel_fraction") if "valid_pixel_fraction" in winter.columns else F.lit(None).cast("double")
    return winter.withColumns({new: F.col(old) for old, new in MEASURES.items()} | {"valid_pixel_fraction": valid}).where("time_period is not null")


def _in_set(quality: float, periods: int) -> Column:
    return (F.col("Q") >= quality) & (F.col("n_periods_used") >= periods)


def assigned(rows: DataFrame, t: Template) -> DataFrame:
    """Rows with enough periods and quality for phase two, by the template's model: features, cluster, best_soft, uncertain, label."""
    featured = trends.features(rows, t.feature_set, t.shrink, t.shrink_level).where(_in_set(t.assign_min_quality, t.min_periods))
    how = (t.columns, t.model, t.confidence_threshold, t.distance_threshold)
    placed = clusters.mixture_assign(featured, *how) if t.method == "gmm" else clusters.nearest(featured, how[0], t.model.centers, *how[2:])
    return clusters.labelled(placed, t.label_map or {}).withColumn("K", F.lit(t.model.k))


def fit(trended: DataFrame, settings: Settings) -> tuple[Template, DataFrame]:
    """(the template fitted on rows of enough quality, the metrics of each K)."""
    name = settings.feature_set
    columns = [f"f_{i}" for i in range(1, len(trends.FEATURE_SETS[name]) + 1)]
    train = trends.features(trended, name, settings.shrink, settings.shrink_level).where(_in_set(settings.min_quality, settings.min_periods))
    choice = clusters.choose_k(train, columns, settings.ks, settings.k_select, settings.cluster_method, settings.silhouette_error)
    model = choice.model
    labels = clusters.label_map(model.centers, settings.label_schema) if name == "cover2" and model.k in (2, 3) else None
    template = Template(
        settings.cluster_method, name, model, labels, settings.shrink, settings.shrink_level, settings.min_quality, settings.assign_min_quality, settings.min_periods,
        settings.confidence_threshold, settings.distance_threshold, settings.trend_periods,
    )
    rows = [(k, s, b, a, model.k, template.method, name, settings.k_select, settings.shrink, settings.shrink_level) for k, s, b, a in choice.scores]
    return template, trended.sparkSession.createDataFrame(rows, _METRICS)


def ages(trended: DataFrame, column: str, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(assignments, centres, metrics) of the summer index, z-scored within seasons and clustered on a line; the final fit is k-means whatever chose K."""
    spark = trended.sparkSession
    z = checkpointed(robust_z(trended.select(*KEYS, F.col(f"`{column}`").alias("index")), ["season_sort"], {"index": "CMI_z"}).where("CMI_z is not null"))
    if z.count() <= min(settings.index_ks):
        none = z.select("season", "season_sort", "orch_id", "CMI_z", F.lit(0).alias("cmi_cluster"), F.lit("").alias("cmi_label")).limit(0)
        return none, spark.createDataFrame([], "cluster int, CMI_z_center double, cmi_label string"), spark.createDataFrame([], "K int, silhouette double, bic double, chosen_k int, method string, chosen_silhouette double, feature string")
    choice = clusters.choose_k(z, ["CMI_z"], settings.index_ks, settings.index_select, "gmm" if settings.index_select == "bic" else "kmeans")
    model = clusters.kmeans(z, ["CMI_z"], choice.model.k) if settings.index_select == "bic" else choice.model
    names = clusters.age_labels([c[0] for c in model.centers])
    own = clusters.labelled(clusters.nearest(z, ["CMI_z"], model.centers), names, out="cmi_label")
    own = checkpointed(own.select(*KEYS, "CMI_z", F.col("cluster").alias("cmi_cluster"), "cmi_label"))
    mean = clusters.mean_silhouette(own.withColumn("k", F.concat_ws("/", "season", "orch_id")), "k", ["CMI_z"], "cmi_cluster")
    centers = spark.createDataFrame([(i, float(c[0]), names[i]) for i, c in enumerate(model.centers)], "cluster int, CMI_z_center double, cmi_label string")
    metrics = spark.createDataFrame([(k, s, b, model.k, "kmeans", mean, column) for k, s, b, _ in choice.scores], "K int, silhouette double, bic double, chosen_k int, method string, chosen_silhouette double, feature string")
    return own, centers, metrics


def index_analysis(joined: DataFrame, score: Column) -> DataFrame:
    """(scope, n, corr_CMI_coverScore, auc_cmi_only): over all seasons and in each; the area is that of a cross-validated regression, null where it can't be fitted."""
    rows = checkpointed(joined.select("season_sort", "CMI_z", score.alias("score"), F.concat_ws("/", "season", "orch_id").alias("k"), F.lower("label").contains("cover").alias("cover")))
    out = analysis.correlations(rows, "CMI_z", "score", "season_sort").withColumnRenamed("corr", "corr_CMI_coverScore")
    return out.join(cross_validated_areas(rows, "k", "CMI_z", "cover").withColumnRenamed("auc", "auc_cmi_only"), "scope", "left")


def cross_validated_areas(rows: DataFrame, key: str, feature: str, positive: str) -> DataFrame:
    """(scope, auc) of GLOBAL and each SEASON_<season_sort>, all fitted side by side."""
    scope = F.explode(F.array_compact(F.array(F.lit("GLOBAL"), F.concat(F.lit("SEASON_"), F.col("season_sort").cast("string")))))
    scores = analysis.cross_validated_scores(rows.select(key, feature, positive, scope.alias("scope")), key, feature, positive, scopes=["scope"])
    return analysis.auc(scores, "score", positive, ["scope"])


_METRICS = "K int, silhouette double, bic double, aic double, chosen_k int, method string, feature_set string, k_select string, shrink_by_r2 string, shrink_level boolean"


def analyse(winter: DataFrame, summer: DataFrame | None = None, settings: Settings = Settings(), template: Template | None = None) -> tuple[dict[str, DataFrame], Template]:
    """(every table of a run by name, the template). winter and summer: as read by sources.readers. With a template nothing is fitted but ages: rows are assigned by it, and there are no metrics."""
    ts = checkpointed(trends.rewards(panel_of(winter), settings.strata))
    trended = trends.with_quality(trends.trends(ts, settings, KEYS))
    column, out = None, {}
    if summer is not None:
        lookup = checkpointed(analysis.group_medians(summer.drop("season_sort"), ["season", "orch_id"]))
        ts, trended = ts.join(lookup, ["season", "orch_id"], "left"), trended.join(lookup, ["season", "orch_id"], "left")
        column = analysis.index_column(lookup.columns, settings.index_column)
    trended = checkpointed(trended)
    template, metrics = fit(trended, settings) if template is None else (template, winter.sparkSession.createDataFrame([], _METRICS))
    columns = template.columns
    every = checkpointed(assigned(trended, template).withColumn("CMI", F.col(f"`{column}`") if column else F.lit(None).cast("double")))
    train = every.where(_in_set(settings.min_quality, settings.min_periods))
    if template.method == "gmm":
        p, _ = clusters.posteriors(columns, template.model)
        train = train.withColumn("p__", p).withColumns({f"p_{i}": F.col("p__")[i] for i in range(template.model.k)}).drop("p__")
    train = checkpointed(train.withColumn("key__", F.concat_ws("/", "season", "orch_id")))
    # silhouettes are read by the tables that show them only: no other table waits for them
    each = clusters.silhouette(train, "key__", columns, "cluster", error=settings.silhouette_error).select("cluster", "silhouette")
    by_season = clusters.silhouette(train, "key__", columns, "cluster", ["season"], settings.silhouette_error).groupBy("season").agg(F.avg("silhouette").alias("s"), F.count_distinct("cluster").alias("k"), F.count(F.lit(1)).alias("n"))
    profiles = analysis.cluster_profiles(train, columns, [c for c in analysis.PROFILED if c in train.columns], each)
    flagged = trended.withColumns({"train": _in_set(settings.min_quality, settings.min_periods), "assigned": _in_set(settings.assign_min_quality, settings.min_periods)})
    spark = winter.sparkSession
    names = template.label_map or {}
    centroids = spark.createDataFrame([(i, *map(float, c), names.get(i)) for i, c in enumerate(template.model.centers)], "cluster int, " + ", ".join(f"{c} double" for c in columns) + ", label string")
    shown = ["season", "season_sort", "orch_id", *columns, "Q", "K", "cluster", "best_soft", "uncertain", "label", "CMI"]
    chosen = each.agg(F.avg("silhouette").alias("chosen_silhouette"))
    out |= {
        "ts": ts, "trends": trended, "assign": train.select(*shown, *[f"p_{i}" for i in range(template.model.k)] if template.method == "gmm" else [F.col("d1").alias("Dmin"), F.col("d2").alias("D2")]),
        "assign_all": every.select(*shown), "centroids": centroids, "metrics": metrics.crossJoin(F.broadcast(chosen)),
        "season_sil": by_season.select("season", F.when((F.col("n") > template.model.k) & (F.col("k") > 1), F.col("s")).alias("silhouette"), "n"),
        "profiles": clusters.labelled(profiles, names), "coverage": analysis.coverage(flagged, "train", "assigned"),
        "flips": sequences.flips(every, columns).orderBy("season_to", "orch_id"), "transitions": sequences.transitions(every), "orchard_profiles": sequences.profiles(every),
    }
    aged = None
    if column and settings.cluster_index:
        aged, centers, index_metrics = ages(trended, column, settings)
        joined = checkpointed(every.join(aged.select("season", "orch_id", "CMI_z", "cmi_label"), ["season", "orch_id"], "left"))
        score = F.col("f_1") + (num(0.8) * F.col("f_2") if len(columns) > 1 else num(0))
        out |= {"cmi_assign": aged, "cmi_centroids": centers, "cmi_metrics": index_metrics, "crosstab": analysis.crosstab(joined, "label", "cmi_label"), "cmi_analysis": index_analysis(joined.where("CMI_z is not null"), score)}
        aged = aged.select("season", "orch_id", "CMI_z", "cmi_label")
    wide = checkpointed(serving.served(every, columns, aged, settings.season_mid))
    seasons = [r[0] for r in wide.select("season_sort").distinct().orderBy("season_sort").collect()]  # years: a handful
    out |= {
        "viz": serving.wide_table(wide), "attrs": serving.attributes(wide, settings.ui_uncertain_threshold), "streaks": sequences.cover_masks(wide, seasons, settings.ui_uncertain_threshold),
        "manifest": serving.manifest(wide, settings.ui_uncertain_threshold),
    }
    return out, template


def write_run(tables: dict[str, DataFrame], template: Template, path: str) -> list[str]:
    """Write a run's tables as CSV, attributes as one shard a season, manifest and template as JSON; the names of what was written."""
    written = []
    for name, df in tables.items():
        if name == "attrs":
            writers.write_shards(df, f"{path}/attrs")
        elif name == "manifest":
            writers.write_json_row(df, f"{path}/manifest.json")
        elif not writers.write_csv(df, f"{path}/{name}", only_if_rows=name in OPTIONAL):
            continue
        written.append(name)
    spark = next(iter(tables.values())).sparkSession
    writers.write_text_row(spark, template.as_json(), f"{path}/template.json")
    return [*written, "template"]


def read_template(spark: SparkSession, path: str) -> Template:
    """The template of a run written to path."""
    return Template.from_json("\n".join(r[0] for r in spark.read.text(f"{path}/template.json").collect()))


def run(spark: SparkSession, winter: Sequence[str], summer: Sequence[str], path: str, settings: Settings = Settings(), legacy: Sequence[str] = ()) -> list[str]:
    """Read files, analyse, and write everything to path; the names of what was written."""
    rows = checkpointed(readers.read_inputs(spark, winter, legacy))
    tables, template = analyse(rows, readers.read_summer(spark, summer) if summer else None, settings)
    return write_run(tables, template, path)


# ---------------------------------------------------------------- documents


def convert(spark: SparkSession, path: str, out: str) -> None:
    """Attributes, streaks and manifest of a run as keyed JSON, one object a file: attrs/<season>.json, attrs/streaks.json and manifest.json."""
    seasons = readers.read_shards(spark, f"{path}/attrs").withColumn("file", F.concat(F.col("season_sort").cast("string"), F.lit(".json"))).drop("season_sort")
    streaks = readers.read_streaks(spark, f"{path}/streaks").withColumn("file", F.lit("streaks.json"))
    lines = writers.keyed_values(seasons, "orch_id", ["file"]).union(writers.keyed_values(streaks, "orch_id", ["file"]))
    documents.write_documents(lines, "file", "orch_id", "value", f"{out}/attrs")
    writers.copy_text(spark, f"{path}/manifest.json", f"{out}/manifest.json")


def merge(spark: SparkSession, root: str, out: str, incremental: bool = True) -> DataFrame:
    """Merge the JSON files of root's folders, key by key, into ``out``; the report's row.

    Incremental: only files whose hash changed since the last run are parsed, and laid over what the last run knew of others. Every run writes its
    own version under run=k; a document is one object, of a file with no key there is none. The log has a row a folder.
    """
    files = checkpointed(readers.discover(spark, root))
    state, known, last = readers.read_runs(spark, f"{out}/state", "folder string, file string, hash string"), readers.read_runs(spark, f"{out}/entries", "folder string, file string, orch_id string, value string"), readers.last_run(spark, f"{out}/state")
    changed = merging.changed_files(files, state if incremental else state.limit(0))
    entries = checkpointed(merging.layered(known if incremental else known.limit(0), merging.entries(changed), changed))
    merged = checkpointed(merging.upsert(entries, ["file", "orch_id"], "folder"))
    number = last + 1
    now = checkpointed(merging.next_state(state, files))
    now.write.mode("overwrite").parquet(f"{out}/state/run={number}")
    merging.merge_log(now).write.mode("overwrite").json(f"{out}/log/run={number}")
    entries.write.mode("overwrite").parquet(f"{out}/entries/run={number}")
    kept = merged.where(F.col("file") != merging.MANIFEST)
    documents.write_documents(kept, "file", "orch_id", "value", f"{out}/merged/run={number}")
    manifests = merging.manifests(entries)
    if not manifests.isEmpty():
        writers.write_json_row(merging.merged_manifest(manifests), f"{out}/merged/run={number}/manifest.json")
    report = checkpointed(merging.run_report(kept, files))
    writers.write_json_row(report, f"{out}/report/run={number}")
    return report
