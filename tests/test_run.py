"""A whole run over small files of the shape of the published inputs, and the relations that its tables have to keep."""

import csv
import hashlib
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborline.config import Settings
from arborline.plans import run as R
from arborline.sources import readers

SEASONS = [f"{y}_{y + 1}" for y in range(2018, 2022)]


def write_inputs(folder, seed):
    """Two kinds of entities, green and bare winters; one entity that changes; zero rows, gaps and a sentinel."""
    r = random.Random(seed)
    winter, summer = [], []
    for s, season in enumerate(SEASONS):
        path, rows = folder / f"winter_{season[:4]}.csv", []
        for e in range(24):
            key, green = f"{seed:03}{e:05}", (e % 5 == 0) != (e == 5 and s == 2)
            for t in range(1, 9):
                high = 0.12 + 0.05 * t if green else 0.01 * (e * 7 % 12)
                if (e, t) == (3, 4):
                    values = [0, 0, 0, 0, 0, 0]
                else:
                    values = [0.15 + high + r.gauss(0, 0.002), 0.05 + abs(r.gauss(0, 0.005)), 0.5, 0.3 - high / 2 + r.gauss(0, 0.002), 0.04 + abs(r.gauss(0, 0.005)), 0.5]
                if not (e == 7 and s == 1):
                    rows.append([key, season, t, f"{season[:4]}-11-16", f"{season[:4]}-11-30", *values, 12.5, "Kern", 8, season[:4], season[5:], r.random()])
        names = "orch_id,season,time_period,period_start_date,period_end_date,orchard_savi_mean,orchard_savi_stddev,orchard_savi_fill,orchard_bsi_mean,orchard_bsi_stddev,orchard_bsi_fill,ACRES,CNTY,stability_score,startyear,endyear,valid_fraction".split(",")
        with open(path, "w", newline="") as f:
            csv.writer(f).writerows([names, *rows])
        winter.append(str(path))
        values = [0.3 + 0.2 * (e % 3 == 0) + r.gauss(0, 0.02) for e in range(24)]
        with open(folder / f"summer_{season[:4]}.csv", "w", newline="") as f:
            z = (np.array(values) - np.mean(values)) / np.std(values)
            rows = [[f"{seed:03}{e:05}", season, season[:4], 8, values[e] if e != 9 else -9999, values[e], 30, 0.9, z[e] if e != 9 else ""] for e in range(24)]
            csv.writer(f).writerows(["orch_id,season,summer_year,stability_score,EVI2_p90_summer_mean,EVI2_p90_summer_median,EVI2_summer_imgcount_mean,valid_fraction,CMI_season_z".split(","), *rows])
        summer.append(str(folder / f"summer_{season[:4]}.csv"))
    return winter, summer


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    """The run of one county, and what it serves under other keys as a second county's."""
    first, second = tmp_path_factory.mktemp("Butte"), tmp_path_factory.mktemp("Kern")
    winter, summer = write_inputs(first, 1)
    tables, template = R.analyse(readers.read_inputs(spark, winter), readers.read_summer(spark, summer))
    out = {"Butte": (first, winter, summer, R.write_run(tables, template, str(first / "out")))}
    other = {n: tables[n].withColumn("orch_id", F.regexp_replace("orch_id", "^001", "002")) for n in ("attrs", "streaks")} | {"manifest": tables["manifest"]}
    return out | {"Kern": (second, winter, summer, R.write_run(other, template, str(second / "out")))}


def rows_of(spark, path, schema=None):
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.csv(str(path), header=True).collect()


def test_tables_are_written(spark, done):
    root, _, _, written = done["Butte"]
    assert set(written) == set("ts trends assign assign_all centroids metrics season_sil profiles coverage flips transitions orchard_profiles cmi_assign cmi_centroids cmi_metrics crosstab cmi_analysis viz attrs streaks manifest template".split())
    assert json.loads(spark.read.text(str(root / "out/manifest.json")).first()[0]) == {"schema_version": 1, "years": [2018, 2019, 2020, 2021], "ui_uncertain_threshold": 0.15, "bit_order": "earliest=bit0"}
    trends = rows_of(spark, root / "out/trends")
    assert len(trends) == 24 * 4 - 1 and all(int(r.n_periods_used) == (4 if r.orch_id.endswith("003") else 5) for r in trends)
    metrics = rows_of(spark, root / "out/metrics")
    assert {r.K for r in metrics} == {"2", "3"} and all(r.chosen_k == "2" and float(r.chosen_silhouette) > 0.5 for r in metrics)
    viz = rows_of(spark, root / "out/viz")
    assert [(r.season_sort, r.orch_id) for r in viz] == sorted((r.season_sort, r.orch_id) for r in viz) and len(viz[0]) == 31
    roles = {(r.orch_id[-5:], r.season): r.cluster_role for r in viz}
    assert all(role == ("Cover Crops" if (int(e) % 5 == 0) != (e == "00005" and s == "2020_2021") else "Bare Soil") for (e, s), role in roles.items())
    flips = [r for r in rows_of(spark, root / "out/flips") if r.flip == "1"]
    assert sorted((r.orch_id[-5:], r.season_to) for r in flips) == [("00005", "2020"), ("00005", "2021")]
    assert sum(int(r.n) for r in rows_of(spark, root / "out/transitions")) == len(rows_of(spark, root / "out/flips")) == 24 * 3 - 1
    assert {r.cmi_label for r in rows_of(spark, root / "out/cmi_centroids")} == {"Young", "Old"}
    assert {r.scope for r in rows_of(spark, root / "out/cmi_analysis")} == {"GLOBAL", *(f"SEASON_{y}" for y in range(2018, 2022))}


def test_attributes_keep_their_relations(spark, done):
    """Streaks follow from attributes; uncertain from softness; streaks and flips from the row of roles."""
    root = done["Butte"][0]
    attributes = readers.read_shards(spark, str(root / "out/attrs")).orderBy("orch_id", "season_sort").collect()
    assert all(r.uncertain == (r.best_soft_norm <= 0.15) for r in attributes)
    by_key = {}
    for r in attributes:
        by_key.setdefault(r.orch_id, []).append(r)
    want = {}
    for key, rows in by_key.items():
        bits = [any(r.season_sort == 2018 + i and r.cluster_role_mapped == "Cover" and r.best_soft_norm > 0.15 for r in rows) for i in range(4)]
        longest = max(len(run) for run in "".join("1" if b else "0" for b in bits).split("0"))
        if any(bits):
            want[key] = (sum(b << i for i, b in enumerate(bits)), longest, sum(bits), True, False)
        streak, last, before = 0, None, None
        for r in rows:
            flipped = before is not None and r.cluster_role_mapped != before
            streak = 1 if before is None or flipped else streak + 1
            last = r.season_sort if flipped else last
            before = r.cluster_role_mapped
            assert (r.streak_len_current, r.flipped_this_season, r.time_since_last_flip) == (streak, flipped, None if last is None else r.season_sort - last)
    assert {r.orch_id: tuple(r)[1:] for r in readers.read_streaks(spark, str(root / "out/streaks")).collect()} == want


def test_strata_follow_from_the_index(spark, done):
    """Robust z of the seasonal z within seasons, then the nearest centre; no index, no stratum."""
    root, _, summer, _ = done["Butte"]
    centers = [(float(r.CMI_z_center), r.cmi_label) for r in rows_of(spark, root / "out/cmi_centroids")]
    strata = {(r.orch_id, r.season_sort): r.stratum for r in readers.read_shards(spark, str(root / "out/attrs")).collect()}
    for path in summer:
        rows = list(csv.DictReader(open(path)))
        z = {r["orch_id"]: float(r["CMI_season_z"]) for r in rows if r["CMI_season_z"]}
        year = int(rows[0]["season"][:4])
        there = {k: v for k, v in z.items() if (k, year) in strata}
        q1, q2, q3 = np.quantile(list(there.values()), [0.25, 0.5, 0.75])
        for key in (r["orch_id"] for r in rows if (r["orch_id"], year) in strata):
            if key not in z:
                assert strata[key, year] is None
                continue
            place = min(3, max(-3, (z[key] - q2) / max(q3 - q1, 1e-6)))
            near = sorted((abs(place - c), label) for c, label in centers)
            assert strata[key, year] == near[0][1] or math.isclose(near[0][0], near[1][0], abs_tol=1e-9)


def test_template_assigns_again(spark, done):
    root = done["Butte"][0]
    template = R.read_template(spark, str(root / "out"))
    trended = spark.read.csv(str(root / "out/trends"), header=True, inferSchema=True).withColumn("orch_id", F.format_string("%08d", F.col("orch_id").cast("int")))
    again = {(r.season, r.orch_id): (r.cluster, r.label) for r in R.assigned(trended, template).collect()}
    first = {(r.season, r.orch_id): (int(r.cluster), r.label) for r in rows_of(spark, root / "out/assign_all")}
    assert again == first and R.Template.from_json(template.as_json()) == template


def test_documents_and_their_merging(spark, done, tmp_path):
    """Converted tables equal the CSV; the merge is by key, counts what it read, and a second run reads only what changed."""
    root = tmp_path / "served"
    for name, (path, *_) in done.items():
        R.convert(spark, str(path / "out"), str(root / name))
    kern = readers.read_shards(spark, str(done["Kern"][0] / "out/attrs")).collect()
    lines = json.loads((root / "Kern/attrs/2018.json").read_text())
    assert lines == {r.orch_id: {c: r[c] for c in R.serving.ATTRIBUTES if c != "orch_id"} for r in kern if r.season_sort == 2018}
    # one key in two folders: the last folder by name wins
    (root / "Zeta").mkdir()
    text = json.dumps({"00100000": {"v": 1}, "zz": {"v": None}})
    (root / "Zeta/2018.json").write_text(text)
    report = R.merge(spark, str(root), str(tmp_path / "merged")).first()
    assert report.years == [2018, 2019, 2020, 2021] and report.folders == ["Butte", "Kern", "Zeta"] and report.n_files == 13 and report.most_orchards == 49
    assert {f.file: (f.orchards, f.n_sources) for f in report.files}["2018.json"] == (49, 3)
    state = {(r.folder, r.file): r.hash for r in readers.read_runs(spark, str(tmp_path / "merged/state"), "folder string").collect()}
    assert state["Zeta", "2018.json"] == hashlib.md5(text.encode()).hexdigest() and len(state) == 13

    def merged(run):
        return json.loads((tmp_path / f"merged/merged/run={run}/2018.json").read_text())

    log = {r.folder: r for r in spark.read.json(str(tmp_path / "merged/log/run=1")).collect()}
    assert set(log) == {"Butte", "Kern", "Zeta"} and log["Zeta"].merged and json.loads(log["Zeta"].file_hashes) == {"2018.json": state["Zeta", "2018.json"]}
    assert merged(1)["00100000"] == {"v": 1} and merged(1)["zz"] == {"v": None} and merged(1)["00200001"] == lines["00200001"]
    assert json.loads(spark.read.text(str(tmp_path / "merged/merged/run=1/manifest.json")).first()[0])["years"] == [2018, 2019, 2020, 2021]
    (root / "Zeta/2018.json").write_text(json.dumps({"zz": {"v": 2}}))
    R.merge(spark, str(root), str(tmp_path / "merged"))
    assert merged(2)["zz"] == {"v": 2} and merged(2)["00100000"] != {"v": 1} and merged(2)["00200001"] == lines["00200001"] and len(merged(2)) == 49
    whole = R.merge(spark, str(root), str(tmp_path / "merged"), incremental=False).first()
    assert merged(3) == merged(2) and whole.most_orchards == 49


@pytest.mark.parametrize("settings", [
    Settings(k_select="bic", trend_periods=(2, 3, 4, 5), use_valid_fraction=False, shrink="linear", index_select="bic"),
    Settings(method="gmm", features="greenup3", shrink_level=True, ks=(2,), confidence_threshold=0.9, cluster_index=False),
    Settings(one_feature="intensity_slope", strata=("CNTY",), label_schema="short", index_column="EVI2_p90_summer_mean", ui_uncertain_threshold=0.3, season_mid="-02-15", min_quality=0.5, min_periods=3, assign_min_quality=0.1, distance_threshold=0.5, index_ks=(3,)),
])
def test_every_setting_counts(spark, done, settings):
    _, winter, summer, _ = done["Kern"]
    tables, template = R.analyse(readers.read_inputs(spark, winter), readers.read_summer(spark, summer), settings)
    assert template.method == settings.cluster_method and template.feature_set == settings.feature_set and template.periods == settings.trend_periods
    every = tables["assign_all"].collect()
    assert every and all(r.K == template.model.k for r in every)
    assert (every[0].label is None) == (settings.feature_set != "cover2")
    attributes = tables["attrs"].collect()
    assert all(r.uncertain == (r.best_soft_norm <= settings.ui_uncertain_threshold) for r in attributes)
    assert {r.season_mid[4:] for r in tables["viz"].select("season_mid").collect()} == {settings.season_mid}
    assert ("cmi_assign" in tables) == settings.cluster_index
    if not settings.cluster_index:
        assert {r.stratum for r in attributes} == {"Mid"}
    if settings.one_feature:
        assert {r.feature for r in tables["cmi_metrics"].collect()} == {"CMI__EVI2_p90_summer_mean"} and {r.chosen_k for r in tables["cmi_metrics"].collect()} == {3}
    if settings.cluster_method == "gmm":
        assert {f"p_{i}" for i in range(template.model.k)} <= set(tables["assign"].columns)


def test_too_little_to_train(spark, done):
    _, winter, _, _ = done["Kern"]
    with pytest.raises(ValueError):
        R.analyse(readers.read_inputs(spark, winter), None, Settings(min_quality=1.1))


def test_a_run_from_files_to_files(spark, done, tmp_path):
    """Without a summer index: no ages, one stratum; legacy paths go before winter ones."""
    _, winter, _, _ = done["Butte"]
    written = R.run(spark, ["nowhere.csv"], [], str(tmp_path), Settings(ks=(2,)), legacy=winter[:2])
    assert "cmi_assign" not in written and {"viz", "attrs", "streaks", "manifest", "template"} <= set(written)
    assert {r.stratum for r in readers.read_shards(spark, str(tmp_path / "attrs")).collect()} == {"Mid"}


def test_no_table_waits_for_silhouettes_it_does_not_show(spark, monkeypatch):
    """A run by a template gives assignments and attributes without comparing all pairs; the tables that show silhouettes still ask for them."""
    from pyspark.sql import functions as F

    from arborline.operators import clusters
    from arborline.plans import queries as Q

    line = clusters.silhouette

    def refused(df, key, columns, cluster, within=(), error=None):
        found = line(df, key, columns, cluster, within, error)
        return found if len(columns) == 1 else df.select(*within, key, cluster, F.raise_error(F.lit("all pairs")).cast("double").alias("silhouette"))

    monkeypatch.setattr(clusters, "silhouette", refused)
    folder = "/root/testdata/sf0.001"
    rows = Q.templated_run(spark, folder)
    assert rows.count() > 0
    model = clusters.Model(2, Q.P.CENTERS, 0.0)
    template = Q.R.Template("kmeans", "cover2", model, clusters.label_map(Q.P.CENTERS), "sqrt", False, 0.2, 0.0, 2, 0.6, 1.5, Q.P.SETTINGS.trend_periods)
    tables, _ = Q.R.analyse(*Q._run_inputs(spark, folder), Q.P.SETTINGS, template)
    assert tables["attrs"].count() > 0
    with pytest.raises(Exception, match="all pairs"):
        tables["profiles"].collect()
