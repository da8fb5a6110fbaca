"""Documents as single JSON objects, and GeoJSON in splits."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from arborline.sources import documents


def rows_of(n, seed=1):
    r = random.Random(seed)
    return [(r.choice(["2018.json", "2019.json", "odd name é.json"]), f'{i:05}"\\ é', json.dumps({"v": i, "s": "a\nb", "n": None})) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_a_document_is_one_object(spark, tmp_path, parts):
    rows = rows_of(500) + [("2018.json", "null", None), (None, "x", "1"), ("2018.json", None, "1")]
    df = spark.createDataFrame(rows, "f string, k string, v string").repartition(parts)
    folder = tmp_path / "attrs"
    (tmp_path / "attrs").mkdir()
    (folder / "2018.json").write_text("old")
    (folder / "other.json").write_text("{}")
    assert documents.write_documents(df, "f", "k", "v", str(folder)) == 3
    assert sorted(os.listdir(folder)) == ["2018.json", "2019.json", "odd name é.json", "other.json"]
    for name in ("2018.json", "2019.json", "odd name é.json"):
        want = {k: v and json.loads(v) for f, k, v in rows if f == name and k is not None}
        got = json.loads((folder / name).read_text())
        assert got == want and list(got) == sorted(got)
    assert documents.write_documents(df.limit(0), "f", "k", "v", str(tmp_path / "none")) == 0 and os.listdir(tmp_path / "none") == []


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    folder = tmp_path / "attrs"
    folder.mkdir()
    (folder / "2018.json").write_text('{"old":1}')
    df = spark.createDataFrame(rows_of(300), "f string, k string, v string").repartition(5)
    broken = df.withColumn("v", F.when(F.col("k").startswith("00299"), F.raise_error(F.lit("no value"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no value"):
        documents.write_documents(broken, "f", "k", "v", str(folder))
    assert os.listdir(folder) == ["2018.json"] and (folder / "2018.json").read_text() == '{"old":1}'


def test_documents_by_uri(spark, tmp_path):
    df = spark.createDataFrame([("a.json", "k", "1")], "f string, k string, v string")
    assert documents.write_documents(df, "f", "k", "v", f"file://{tmp_path}/out") == 1
    assert json.loads((tmp_path / "out/a.json").read_text()) == {"k": 1}


def collection(n, seed):
    r = random.Random(seed)
    features = []
    for i in range(n):
        odd = r.choice(['a"b', "x\\", "\\\\\"", "{[", "]}", '"features":[', "é😀", "", "\n"])
        features.append({"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[i, 0.5], [1, 0], [1, 1], [i, 0.5]]]}, "properties": {"orch_id": f"{i}{odd}", "ACRES": i / 2, "nested": {"features": [{"type": "Feature"}], odd: [odd, {odd: odd}]}}})
    top = {"type": "FeatureCollection", "name": '\\"features":[', "crs": {"features": [{"type": "Feature", "properties": {"orch_id": "crs"}}]}, "links": [{"type": "Feature", "properties": {"orch_id": "link"}}], "features": features, "after": [{"properties": {"orch_id": "after"}}]}
    return json.dumps(top, ensure_ascii=bool(seed % 2), indent=[None, 1, 3][seed % 3])


@pytest.mark.parametrize("seed, split", [(0, 97), (1, 256), (2, 1000), (3, 64), (4, 1 << 20)])
def test_features_in_splits_are_those_of_the_whole_text(spark, tmp_path, seed, split, monkeypatch):
    from arborline.sources import geojson, readers

    monkeypatch.setattr(geojson, "STEP", 50)
    text = collection(30, seed)
    (tmp_path / "a.geojson").write_text(text)
    (tmp_path / "b c.geojson").write_text(json.dumps({"features": [None, 3, {"properties": {"orch_id": "only"}}], "x": 1}))
    for name, empty in (("c", ""), ("d", "{}"), ("e", '{"features":[]}'), ("f", '{"features" : { "a" : [ { "properties" : {} } ] } }')):
        (tmp_path / f"{name}.geojson").write_text(empty)
    df = geojson.read_features(spark, str(tmp_path), "orch_id string, ACRES double", split)
    got = sorted(((r.orch_id, r.ACRES, r.geometry and json.loads(r.geometry)) for r in df.collect()), key=str)
    want = [(f["properties"]["orch_id"], f["properties"]["ACRES"], f["geometry"]) for f in json.loads(text)["features"]] + [("only", None, None)]
    assert got == sorted(want, key=str)
    whole = readers.read_features(spark, str(tmp_path / "a.geojson"), "orch_id string, ACRES double").collect()
    assert sorted((r.orch_id, r.ACRES) for r in whole) == sorted((a, b) for a, b, _ in want if a != "only")


def test_features_of_one_file_are_read_by_several_tasks(spark, tmp_path):
    from arborline.sources import geojson

    (tmp_path / "a.geojson").write_text(collection(200, 5))
    df = geojson.read_features(spark, str(tmp_path / "a.geojson"), "orch_id string", 8_000)
    assert len({r[0] for r in df.select(F.spark_partition_id()).distinct().collect()}) > 3 and df.count() == 200


@pytest.mark.parametrize("seed", range(40))
def test_structure_of_pieces(seed):
    from arborline.sources import geojson

    text = collection(3, seed).encode()
    whole, depth, end = geojson.structure(text, geojson.OUTSIDE)
    assert end == geojson.OUTSIDE and depth[-1] == 0
    cut = random.Random(seed).randrange(len(text))
    a, da, state = geojson.structure(text[:cut], geojson.OUTSIDE)
    b, db, end = geojson.structure(text[cut:], state)
    assert end == geojson.OUTSIDE and [*a, *(b + cut)] == list(whole) and [*da, *(db + (da[-1] if len(da) else 0))] == list(depth)
