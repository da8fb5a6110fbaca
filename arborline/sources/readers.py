"""Readers of panel, summer index, attribute, JSON and polygon files."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborline.functions.scalars import null_if_nan, season_from_path, season_sort

SUMMER = "orch_id string, season string, summer_year int, stability_score double, EVI2_p90_summer_mean double, EVI2_p90_summer_median double, EVI2_summer_imgcount_mean double, valid_fraction double, CMI_season_z double"
WINTER = (
    "orch_id string, season string, time_period int, period_start_date string, period_end_date string, orchard_savi_mean double, orchard_savi_stddev double, orchard_savi_fill double, "
    "orchard_bsi_mean double, orchard_bsi_stddev double, orchard_bsi_fill double, ACRES double, CNTY string, stability_score double, startyear int, endyear int"
)
ATTRIBUTES = "orch_id string, cluster_role_mapped string, best_soft_norm double, uncertain boolean, flipped_this_season boolean, streak_len_current double, time_since_last_flip double, npts_total int, env_z_season double, stratum string"
STREAKS = "orch_id string, mask int, longest int, years_active int, ever_cover boolean, never_cover boolean"
#: What exports write for a missing summer index; fixed value.
SENTINEL = -9999.0


#: Header lines that are asked for at a time.
HEADER_THREADS = 16


def _first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file, compressed or not, of any store that Spark reads; no more than a buffer of it is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        return jvm.java.io.BufferedReader(text).readLine() or ""
    finally:
        stream.close()


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of paths, which may be folders and patterns, by the names in their header lines. Spark lists the files without reading them."""
    files = sorted(r.path for r in spark.read.format("binaryFile").load(list(paths)).select("path").collect())
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        lines = list(pool.map(lambda p: _first_line(spark, p), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(files, lines):
        names = next(csv.reader([line.lstrip("\ufeff")]), [])
        found.setdefault(tuple(n.strip() for n in names), []).append(path)
    return found


def _csv(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    """CSV files by the names in their headers; columns a file lacks are null, and a missing season comes from startyear or the path.

    Files with one header are one scan.
    """
    if not paths:
        raise ValueError("no input files")
    df = None
    for names, files in headers(spark, paths).items():
        if not names:  # an empty file
            continue
        part = spark.read.schema(", ".join(f"`{n.replace(chr(96), chr(96) * 2)}` string" for n in names)).csv(files, header=True, enforceSchema=True).withColumn("source_csv", F.col("_metadata.file_path"))
        df = part if df is None else df.unionByName(part, allowMissingColumns=True)
    if df is None:
        raise ValueError("no input files")
    if "valid_fraction" in df.columns and "valid_pixel_fraction" not in df.columns:
        df = df.withColumn("valid_pixel_fraction", F.col("valid_fraction"))
    if "valid_pixel_fraction" in df.columns:
        df = df.withColumn("valid_pixel_fraction", null_if_nan(F.col("valid_pixel_fraction").try_cast("double")))
    for field in schema.split(", "):
        name, kind = field.split(" ")
        value = F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)
        df = df.withColumn(name, null_if_nan(value) if kind == "double" else value)
    known = [F.col("season"), F.col("startyear").cast("string")] if "startyear" in df.columns else [F.col("season")]
    season = F.coalesce(*known, season_from_path(F.col("source_csv")).cast("string"))
    return df.withColumn("season", season).withColumn("season_sort", season_sort(season))


def read_winter(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return _csv(spark, paths, WINTER)


def read_summer(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Summer index files; the sentinel becomes null."""
    df = _csv(spark, paths, SUMMER)
    return df.withColumns({c: F.when(F.col(c) != SENTINEL, F.col(c)) for c in ("EVI2_p90_summer_mean", "EVI2_p90_summer_median")})


def read_inputs(spark: SparkSession, winter: Sequence[str], legacy: Sequence[str] = ()) -> DataFrame:
    """Winter files; legacy paths, if any, win. Neither is an error."""
    if not (legacy or winter):
        raise ValueError("no winter input")
    return read_winter(spark, legacy or winter)


def read_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Shards attrs/<season>.csv with their season_sort."""
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+)\.csv$", 1)
    return spark.read.schema(ATTRIBUTES).csv(f"{folder}/*.csv", header=True).withColumn("season_sort", stem.try_cast("int"))


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shards as writers.write_shards leaves them, one folder a season."""
    return spark.read.schema(f"{ATTRIBUTES}, season_sort int").csv(folder, header=True)


def read_streaks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STREAKS).csv(path, header=True)


#: Folders of output and scratch, which are no input; fixed values.
SKIPPED = ("webapp", "output", "temp")


def discover(spark: SparkSession, root: str, skip: Sequence[str] = SKIPPED) -> DataFrame:
    """(folder, file, hash, content) of the JSON files in root's folders and their attrs folders, as single files or as folders of parts.

    Hidden and skipped folders are left out, and an attrs file goes before one of its name beside it. hash is the md5 of a file's content, of a file in parts
    that of the parts' hashes in order; every part is a row.
    """
    # files are chosen by their paths; only then are the chosen ones read
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length").where(F.col("path").rlike(DOCUMENT) & (F.col("length") > 0))
    folder = F.regexp_extract("path", DOCUMENT, 1)
    chosen = [r.path for r in listed.where(~folder.startswith(".") & ~F.lower(folder).isin(*skip)).select("path").collect()]
    if not chosen:
        return spark.createDataFrame([], "folder string, file string, hash string, content binary")
    files = spark.read.format("binaryFile").load(chosen)
    part = lambda k: F.regexp_extract("path", DOCUMENT, k)
    found = files.select(part(1).alias("folder"), part(3).alias("file"), (part(2) != "").alias("deep"), "path", "content", F.md5("content").alias("md5"))
    kept = found.where(~F.col("folder").startswith(".") & ~F.lower("folder").isin(*skip))
    hashes = F.transform(F.array_sort(F.collect_list(F.struct("path", "md5"))), lambda p: p["md5"])
    whole = kept.groupBy("folder", "file", "deep").agg(hashes.alias("parts"))
    named = whole.select("folder", "file", "deep", F.when(F.size("parts") == 1, F.col("parts")[0]).otherwise(F.md5(F.array_join("parts", "").cast("binary"))).alias("hash"))
    first = named.groupBy("folder", "file").agg(F.max("deep").alias("deep"), F.max_by("hash", "deep").alias("hash"))
    return kept.join(first, ["folder", "file", "deep"]).select("folder", "file", "hash", "content")


#: .../folder/[attrs/][file=]name.json, as a file or with the parts of one below it.
DOCUMENT = r"([^/]+)/(attrs/)?(?:file=)?([^/]+\.json)(?:/part-[^/]*)?$"


def read_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of GeoJSON collections: geometry as JSON text, and the properties."""
    schema = f"features array<struct<geometry:string,properties:struct<{properties}>>>"
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", schema)["features"]).alias("f")).select(F.col("f.geometry").alias("geometry"), "f.properties.*")


def county_of_file(name: Column) -> Column:
    """The county in a polygon file's name, in lower case."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.when(stem == "FresnoAlmondOrchards", "fresno").otherwise(F.lower(F.regexp_replace(stem, "_almonds_stable_orchards$", "")))


def parquet_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def last_run(spark: SparkSession, path: str) -> int:
    """The number of the last run=k below path; 0 if there is none."""
    df = parquet_or_none(spark, path)
    return 0 if df is None else df.agg(F.max("run")).first()[0] or 0


def read_runs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table of the last run=k below path, or an empty one of this schema."""
    df = parquet_or_none(spark, path)
    if df is None:
        return spark.createDataFrame([], schema)
    return df.where(F.col("run") == last_run(spark, path)).drop("run")


def years(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
