import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborline.functions import quantiles
from arborline.functions import scalars as S
from arborline.operators import analysis, clusters, merging, pixels, robust, sequences, trends
from arborline.sources import readers, writers

@pytest.mark.parametrize("seed", range(3))
def test_weighted_trend_follows_polyfit(spark, seed):
    r = np.random.default_rng(seed)
    x, y, w = np.arange(3.0, 8), r.normal(size=5), r.uniform(0.1, 4, 5)
    df = spark.createDataFrame([("a", float(a), float(b), float(c)) for a, b, c in zip(x, y, w)], "k string, t double, y double, w double")
    got = trends.weighted_trend(df, ["k"], "t", ["y"], F.col("w"), F.col("t").isin(3, 4, 5, 6, 7)).first()
    m, b = np.polyfit(x, y, 1, w=w)
    mean = (w * y).sum() / w.sum()
    assert got.slope_y == pytest.approx(m) and got.intercept_y == pytest.approx(b)
    assert got.r2_y == pytest.approx(1 - (w * (y - m * x - b) ** 2).sum() / ((w * (y - mean) ** 2).sum() + 1e-6))


def test_weighted_trend_edges(spark):
    rows = [("one", 3, 1.0, 1.0), ("none", 9, 1.0, 1.0), ("same", 4, 2.0, 1.0), ("same", 4, 4.0, 1.0), ("zero", 3, 1.0, 0.0), ("zero", 4, 2.0, -1.0), ("gap", 3, None, 1.0), ("gap", 4, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, t int, y double, w double")
    got = {r.k: r for r in trends.weighted_trend(df, ["k"], "t", ["y"], F.col("w"), F.col("t") < 8).collect()}
    assert got["one"].slope_y is None and got["none"].n_periods_used == 0 and got["gap"].n_periods_used == 2 and got["gap"].slope_y is None
    assert got["same"].slope_y == pytest.approx(3 / 8) and got["same"].intercept_y == pytest.approx(1.5)
    assert got["zero"].slope_y == pytest.approx(1.0)


@pytest.mark.parametrize("n", [1, 2, 99, 100, 30_000])
def test_bracketed_quantiles_are_exact(spark, n):
    values = np.random.default_rng(n).normal(size=n)
    values[: n // 3] = 0.25
    df = spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate(values)], "g int, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for row in quantiles.bracketed_quantiles(df, ["g"], ["v"], probs).collect():
        assert row.v__q == pytest.approx(list(np.quantile(values[row.g :: 2], probs)))


def test_missing_values_stay_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), (None, 3.0)], "g string, v double")
    got = robust.robust_z(df, ["g"], {"v": "z"}).collect()
    assert [r.z for r in got if r.v is None] == [None]
    assert all(r.m == 0 for r in robust.robust_minmax(df, ["g"], "v", "m").where("g is null or v is null").collect())


def test_row_is_missing(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0), (0.0, None, 0.0, 0.0), (0.0, 0.1, 0.0, 0.0)], "savi_mean double, bsi_mean double, savi_sd double, bsi_sd double")
    assert trends.drop_missing(df).count() == 2


def test_nearest_with_gaps(spark):
    df = spark.createDataFrame([(0.0, 0.0), (None, 1.0), (None, None)], "a double, b double")
    rows = clusters.nearest(df, ["a", "b"], [[0.0, 0.0], [1.0, 1.0]]).collect()
    assert (rows[0].cluster, rows[0].best_soft) == (0, 1.0)
    assert rows[1].cluster == 1 and rows[1].d2 == pytest.approx(math.sqrt(2))
    assert (rows[2].cluster, rows[2].best_soft, rows[2].uncertain) == (0, None, 1)


def test_models_find_two_groups(spark):
    r = np.random.default_rng(1)
    rows = [(float(a), float(b)) for c in (-2, 2) for a, b in r.normal(c, 0.3, (60, 2))]
    df = spark.createDataFrame(rows, "a double, b double")
    choice = clusters.choose_k(df, ["a", "b"], (2, 3))
    model = choice.model
    assert model.k == 2 and choice.score(2) > 0.8 > choice.score(3) and clusters.label_map(model.centers)[int(np.argmax([c[0] for c in model.centers]))] == "Likely Cover Cropping"
    mixture = clusters.gaussian_mixture(df, ["a", "b"], 2)
    assert sorted(round(c[0]) for c in mixture.centers) == [-2, 2]
    assert clusters.mixture_assign(df, ["a", "b"], mixture).where("uncertain = 1").count() == 0
    with pytest.raises(ValueError):
        clusters.choose_k(df.limit(2), ["a", "b"], (2, 3))


@pytest.mark.parametrize("cell", [2048, 16])
def test_silhouette_is_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(clusters, "SILHOUETTE_CELL", cell)
    r = np.random.default_rng(2)
    rows = [(i % 3 if i < 90 else 3 + i % 2, i, int(r.integers(0, 3)) if i < 90 else 7, float(round(r.normal(), 1)), float(r.normal())) for i in range(92)] + [(0, 500, 9, 0.5, 0.5), (None, 501, 1, 0.0, 0.0), (1, 502, 1, None, 0.0)]
    df = spark.createDataFrame(rows, "g int, k int, c int, a double, b double")
    for columns in (["a"], ["a", "b"]):
        whole = [x for x in rows if None not in x[3 : 3 + len(columns)]]
        want = {}
        for g, k, c, *x in whole:
            d = {}
            for g2, k2, c2, *y in whole:
                if g2 == g and k2 != k:
                    d.setdefault(c2, []).append(math.dist(x[: len(columns)], y[: len(columns)]))
            others = [np.mean(v) for c2, v in d.items() if c2 != c]
            want[k] = None if not others else 0.0 if c not in d else (min(others) - np.mean(d[c])) / max(min(others), np.mean(d[c]))
        got = {x.k: x.silhouette for x in clusters.silhouette(df, "k", columns, "c", ["g"]).collect()}
        assert got.keys() == want.keys() and all(got[k] == (None if want[k] is None else pytest.approx(want[k], abs=1e-9)) for k in want)


@pytest.mark.parametrize("most", [10_000, 1])
def test_brackets_bring_no_group_to_a_task(spark, monkeypatch, most):
    """Rows of a group are not gathered by its key, whether brackets are broadcast or joined; null keys and columns keep their quantiles."""
    monkeypatch.setattr(quantiles, "MOST_BRACKETS", most, raising=False)
    df = spark.range(0, 40_000, 1, 4).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 > 0, F.col("id") * 1.5).alias("a"), (F.col("id") % 50).alias("b"))
    plan = quantiles._ranked(df, ["g"], ["a", "b"], [0.25, 0.5], 3e-4)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan if most > 1 else "part" in plan
    got = {r.g: (r.a__q, r.b__q) for r in quantiles.bracketed_quantiles(df, ["g"], ["a", "b"], [0.25, 0.5]).collect()}
    assert got == {r.g: (r.a__q, r.b__q) for r in quantiles.group_quantiles(df, ["g"], ["a", "b"], [0.25, 0.5]).collect()}


def test_choices_share_their_distances(spark, monkeypatch):
    """All pairs are compared once for several K, on several tasks though the table is small; each K's mean is that of its own silhouettes."""
    monkeypatch.setattr(clusters, "SILHOUETTE_CELL", 16)
    r = np.random.default_rng(5)
    df = spark.createDataFrame([(i, float(r.normal(i % 3)), float(r.normal())) for i in range(150)], "k int, a double, b double")
    sums, calls = clusters._block_sums, []
    monkeypatch.setattr(clusters, "_block_sums", lambda *a: calls.append(1) or sums(*a))
    choice = clusters.choose_k(df, ["a", "b"], (2, 3))
    assert len(calls) == 1 and [k for k, *_ in choice.scores] == [2, 3]
    rows = clusters.nearest(df, ["a", "b"], choice.model.centers)
    assert choice.score(choice.model.k) == pytest.approx(clusters.mean_silhouette(rows, "k", ["a", "b"], "cluster"), abs=1e-12)
    plan = clusters.silhouette(rows, "k", ["a", "b"], "cluster")._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_mixture_of_large_values(spark):
    r = np.random.default_rng(4)
    rows = [(float(v),) for v in np.concatenate([r.normal(1e8, 1, 200), r.normal(1e8 + 20, 3, 100)])]
    model = clusters.gaussian_mixture(spark.createDataFrame(rows, "a double"), ["a"], 2)
    (m1, v1, w1), (m2, v2, w2) = sorted(zip([c[0] - 1e8 for c in model.centers], [v[0] for v in model.variances], model.weights))
    assert (m1, m2) == (pytest.approx(0, abs=0.3), pytest.approx(20, abs=1)) and 0.7 < v1 < 1.4 and 5 < v2 < 14 and w1 == pytest.approx(2 / 3, abs=0.02)


def test_a_rare_far_group_is_found(spark, monkeypatch):
    """The rows by hash that a start could be drawn from hold none of it."""
    monkeypatch.setattr(clusters, "START_ROWS", 50)
    r = np.random.default_rng(6)
    rows = [tuple(map(float, v)) for v in np.concatenate([r.normal(0, 1, (4000, 2)), r.normal(40, 0.1, (3, 2))])]
    df = spark.createDataFrame([*rows, *[rows[0]] * 1000], "a double, b double").repartition(3)
    x, w = clusters._few(df, ["a", "b"], 50)
    assert x.max() < 20
    x, w = clusters._sample(df, ["a", "b"], 2)
    assert x.max() > 30 and w.sum() == len(rows) + 1000 and len(x) < 1000
    model = clusters.kmeans(df, ["a", "b"], 2, 5)
    assert sorted(round(c[0]) for c in model.centers) == [0, 40]
    assert sorted(round(c[0]) for c in clusters.gaussian_mixture(df, ["a", "b"], 2, 3).centers) == [0, 40]
    with pytest.raises(ValueError, match="no row"):
        clusters.kmeans(df.limit(0), ["a", "b"], 2)


def test_brackets_widen_until_they_hold(spark, monkeypatch):
    values = np.random.default_rng(5).normal(size=25_000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    # a sketch far coarser than its bound says
    real = quantiles.F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda c, at, accuracy: real(c, at, 20))
    got = quantiles.bracketed_quantiles(df, [], ["v"], [0.25, 0.5, 0.9]).first()
    assert got.v__q == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.9])))


def test_quantiles_go_by_the_largest_group(spark, monkeypatch):
    df = spark.createDataFrame([(i % 2, float(i)) for i in range(40)] + [(None, 7.0)], "g int, v double")
    plain = sorted(map(tuple, quantiles.with_quantiles(df, ["g"], ["v"], [0.5]).collect()), key=str)
    monkeypatch.setattr(quantiles, "SMALL_GROUP", 3)
    assert sorted(map(tuple, quantiles.with_quantiles(df, ["g"], ["v"], [0.5]).collect()), key=str) == plain
    more = df.union(spark.createDataFrame([(9, None)], "g int, v double"))
    got = {r.g: r.v__q for r in quantiles.exact_quantiles(more, ["g"], ["v"], [0.5]).collect()}
    assert got == {0: [19.0], 1: [20.0], None: [7.0], 9: None}


def test_season_z_with_and_without_spread(spark):
    values = {"a": [1.0, 2.0, 4.0, 9.0], "b": [3.0, 3.0], None: [1.0, 5.0]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "season string, x double")
    for row in robust.season_z(df, ["season"], "x", "z").collect():
        x = np.array(values[row.season])
        assert row.z == pytest.approx((row.x - x.mean()) / x.std() if x.std() else 0.0)


@pytest.mark.parametrize("n", [1, 63, 64, 200])
def test_masks_of_any_number_of_seasons(spark, n):
    r = np.random.default_rng(n)
    rows = [(k, 1900 + i, "Cover Crops" if r.random() < 0.7 else "Bare Soil", 0.9 if r.random() < 0.9 else 0.1) for k in "abcde" for i in range(n)] + [("a", 1900, "Cover Crops", 0.9), (None, 1900, "Cover Crops", 0.9), ("z", 3000, "Cover Crops", 0.9)]
    df = spark.createDataFrame(rows, "orch_id string, season_sort int, cluster_role string, best_soft_norm double")
    got = {x.orch_id: x for x in sequences.cover_masks(df, range(1900, 1900 + n)).collect()}
    want = {}
    for k, s, role, soft in rows:
        if k and s < 3000 and role == "Cover Crops" and soft > 0.15:
            want.setdefault(k, set()).add(s - 1900)
    assert got.keys() == want.keys()
    for k, seasons in want.items():
        words = [got[k].mask] if n <= 63 else list(got[k].mask)
        assert n <= 63 or len(words) == -(-n // 64)
        assert {64 * w + i for w, m in enumerate(words) for i in range(64) if m >> i & 1} == seasons
        text = "".join(str(int(i in seasons)) for i in range(n))
        assert got[k].longest == max(map(len, text.split("0"))) and got[k].years_active == len(seasons)
    assert {x.longest for x in sequences.cover_masks(df.where("best_soft_norm < 0.15"), range(1900, 1900 + n)).collect()} <= {0}


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.1, False), (0.4, True), (0.4, False), (0.9, True)], "s double, y boolean")
    assert analysis.auc(df, "s", "y").first().auc == pytest.approx(0.875)
    assert analysis.auc(df.where("y"), "s", "y").first().auc is None


def test_merging(spark):
    old = spark.createDataFrame([("a", "f", "1", "1"), ("b", "f", "2", "2"), ("a", "g", "5", "5")], "folder string, file string, orch_id string, value string")
    new = spark.createDataFrame([("a", "f", "3", "3"), ("a", "f", "2", "9")], "folder string, file string, orch_id string, value string")
    assert {(r.file, r.orch_id, r.value) for r in merging.merge_onto(old, new, ["file", "orch_id"]).collect()} == {("f", "3", "3"), ("f", "2", "2"), ("g", "5", "5")}
    twice = [("a", "f", '{"x":1,"y":2,"x":3}'), ("b", "manifest.json", '{"years":[1]}\n{"years":[2,3],"bit_order":"q"}'), ("c", "manifest.json", '{"years":[1,4],"years":[5]}')]
    repeated = merging.entries(spark.createDataFrame(twice, "folder string, file string, content string"))
    assert {(r.folder, r.orch_id): r.value for r in repeated.where("file = 'f'").collect()} == {("a", "x"): "3", ("a", "y"): "2"}
    assert {r.folder: r.years for r in merging.manifests(repeated).collect()} == {"b": [2, 3], "c": [5]}
    gaps = spark.createDataFrame([("k", None, "old"), ("k", 1, "new"), ("n", None, "only"), ("m", 2, None), ("m", 1, "x")], "key string, o int, v string")
    assert {(r.key, r.o, r.v) for r in merging.upsert(gaps, ["key"], "o").collect()} == {("k", 1, "new"), ("n", None, "only"), ("m", 2, None)}
    log = merging.merge_log(spark.createDataFrame([("a", "f", "h1"), ("a", "g", "h2"), ("b", "f", "h3")], "folder string, file string, hash string"))
    assert {r.folder: (r.merged, r.n_files, json.loads(r.file_hashes)) for r in log.collect()} == {"a": (True, 2, {"f": "h1", "g": "h2"}), "b": (True, 1, {"f": "h3"})}
    docs = [("a", "f", '{"x": {"v": 1},\n "y": null}'), ("b", "f", "[1]"), ("c", "f", '{"x":{"v":2}}\n{"z":[1,2]}\n'), ("d", "f", "")]
    found = merging.entries(spark.createDataFrame(docs, "folder string, file string, content string"))
    assert {(r.folder, r.orch_id, r.value) for r in found.collect()} == {("a", "x", '{"v":1}'), ("a", "y", None), ("c", "x", '{"v":2}'), ("c", "z", "[1,2]")}


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("00a", 2018, 1.5, None), ("00b", 2019, None, "x")], "orch_id string, season_sort int, v double, s string")
    assert {r.season_sort: r.entry for r in writers.keyed_entries(df, "orch_id", ["season_sort"]).collect()} == {2018: '"00a":{"v":1.5,"s":null}', 2019: '"00b":{"v":null,"s":"x"}'}
    writers.write_keyed_lines(df, "orch_id", str(tmp_path / "lines"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "lines")).collect()) == ['{"00a":{"season_sort":2018,"v":1.5,"s":null}}', '{"00b":{"season_sort":2019,"v":null,"s":"x"}}']
    writers.write_shards(df, str(tmp_path / "shards"))
    assert spark.read.csv(str(tmp_path / "shards"), header=True).where("season_sort = 2019").count() == 1
    assert not writers.write_csv(df.limit(0), str(tmp_path / "none"), only_if_rows=True)
    assert readers.read_runs(spark, str(tmp_path / "nothing"), "folder string").count() == 0 and readers.last_run(spark, str(tmp_path / "nothing")) == 0
    root = tmp_path / "root"
    for name, text in {"Butte/attrs/2018.json": '{"a":{"v":1}}', "Butte/2018.json": '{"b":{"v":1}}', "webapp/2018.json": "{}", ".hid/2018.json": "{}", "Kern/attrs/file=2019.json/part-1.txt": "{}", "Kern/attrs/file=2019.json/part-0.txt": '{"c":1}'}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    found = sorted((r.folder, r.file, r.hash, bytes(r.content)) for r in readers.discover(spark, str(root)).collect())
    both = md5(md5('{"c":1}') + md5("{}"))
    assert found == [("Butte", "2018.json", md5('{"a":{"v":1}}'), b'{"a":{"v":1}}'), ("Kern", "2019.json", both, b'{"c":1}'), ("Kern", "2019.json", both, b"{}")]
    (tmp_path / "shapes.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]},"properties":{"orch_id":"00a","CNTY":"Kern","ACRES":2.5}}]}')
    feature = readers.read_features(spark, str(tmp_path / "shapes.geojson"), "orch_id string, CNTY string, ACRES double").first()
    assert (feature.orch_id, feature.CNTY, feature.ACRES) == ("00a", "Kern", 2.5) and json.loads(feature.geometry)["type"] == "Polygon"


def test_winter_reader(spark, tmp_path):
    (tmp_path / "x_2019_w.csv").write_text("orch_id,time_period,orchard_savi_mean,startyear\n001,1,nan,\n002,2,0.5,2018\n")
    (tmp_path / "y.csv").write_text("season,orch_id,extra,valid_fraction\n2020_2021,003,q,0.5\n")
    rows = readers.read_winter(spark, [str(tmp_path / "x_2019_w.csv"), str(tmp_path / "y.csv")]).orderBy("orch_id").collect()
    assert (rows[2].season, rows[2].extra, rows[2].valid_pixel_fraction, rows[2].time_period) == ("2020_2021", "q", 0.5, None)
    with pytest.raises(ValueError):
        readers.read_inputs(spark, [])
    assert (rows[0].orch_id, rows[0].orchard_savi_mean, rows[0].season_sort) == ("001", None, 2019) and rows[1].season_sort == 2018


def test_headers_are_read_alone(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv").write_text('\ufefforch_id,"time, period",v\n1,2,3\n')
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/b c.csv").write_text("v,orch_id\n9,8")
    (tmp_path / "sub/empty.csv").write_text("")
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("orch_id,v\n7,1\n")
    found = readers.headers(spark, [str(tmp_path / "*.csv*"), str(tmp_path / "sub")])
    assert {k: [p.rsplit("/", 1)[1].replace("%20", " ") for p in v] for k, v in found.items()} == {("orch_id", "time, period", "v"): ["a.csv"], ("v", "orch_id"): ["b c.csv"], ("orch_id", "v"): ["z.csv.gz"]}
    rows = readers.read_winter(spark, [str(tmp_path / "a.csv"), str(tmp_path / "sub/b c.csv"), str(tmp_path / "z.csv.gz")])
    assert sorted((r.orch_id, r.v, r["time, period"]) for r in rows.collect()) == [("1", "3", "2"), ("7", "1", None), ("8", "9", None)]


def test_windows_overlap(spark):
    windows = pixels.winter_windows(spark, 2020)
    days = spark.createDataFrame([("2020-11-28",), ("2021-01-03",), ("2021-06-01",)], "d string").select(F.to_date("d").alias("d"))
    assert pixels.in_windows(days, "d", windows).groupBy("d").count().orderBy("d").collect()[0]["count"] == 2


def test_scalars(spark):
    row = spark.range(1).select(
        S.season_sort(F.lit("2018_2019")).alias("a"), S.season_mid(F.lit("2018_2019")).alias("b"), S.season_sort(F.lit("x")).alias("c"), S.alpha100(F.lit(0.125)).alias("d"),
        S.season_from_path(F.lit("a/1999_2040_2017.csv")).alias("e"), S.typed(F.lit("True"), "bool").alias("f"), S.typed(F.lit("3.0"), "int").alias("g"), readers.county_of_file(F.lit("Kern_almonds_stable_orchards.geojson")).alias("h"),
        S.ring_area(F.array(*[F.array(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])).alias("area"),
    ).first()
    assert tuple(row)[:8] == (2018, "2019-01-31", None, 12, 2017, True, 3, "kern")
    assert row.area == pytest.approx(1.2391e10, rel=1e-3)
    with pytest.raises(ValueError):
        S.shrink_factor(F.lit(1.0), "cubic")
