"""Merging of keyed documents from several folders, and incremental runs by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(documents: DataFrame, key: list[str], order: str) -> DataFrame:
    """Of rows that share a key the one that is last in ``order``, nulls first; order has to be distinct within a key.

    An aggregation, so that each task keeps one row a key before the shuffle, however many rows a key has.
    """
    others = [c for c in documents.columns if c not in key]
    last = documents.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct(order)).alias("last__"))
    return last.select(*[F.col(c) if c in key else F.col("last__")[c].alias(c) for c in documents.columns])


def changed_files(files: DataFrame, state: DataFrame) -> DataFrame:
    """Files (folder, file, hash, content) whose hash is not in the state (folder, file, hash)."""
    return files.join(state.select("folder", "file", "hash"), ["folder", "file", "hash"], "left_anti")


def next_state(state: DataFrame, files: DataFrame) -> DataFrame:
    """The state after a run: new hashes over old ones."""
    new = files.select("folder", "file", "hash", F.lit(1).alias("run")).distinct()
    return upsert(state.select("folder", "file", "hash", F.lit(0).alias("run")).union(new), ["folder", "file"], "run").drop("run")


def layered(previous: DataFrame, new: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of changed files (folder, file) over the previous rows: a changed file's old rows go, other files' stay."""
    kept = previous.join(changed.select("folder", "file").distinct(), ["folder", "file"], "left_anti")
    return kept.unionByName(new)


def merge_onto(previous: DataFrame, changed: DataFrame, key: list[str]) -> DataFrame:
    """layered, and of rows that share the key the one of the last folder by name. Both have folder and file."""
    return upsert(layered(previous, changed, changed), key, "folder")


#: The file that holds a folder's seasons rather than entities; fixed value.
MANIFEST = "manifest.json"


def entries(files: DataFrame) -> DataFrame:
    """(folder, file, orch_id, value) of each key of the files' JSON objects; value is JSON text. A file is one object or lines of objects; what is no object is skipped.

    A key that repeats in a file counts once, with its last value, as JSON readers take it.
    """
    text = F.col("content").cast("string")
    whole = F.from_json(text, "map<string,string>")
    lines = F.filter(F.transform(F.split(text, "\n"), lambda line: F.from_json(line, "map<string,string>")), lambda m: m.isNotNull())
    maps = F.when(F.instr(F.trim(text), "\n") == 0, F.filter(F.array(whole), lambda m: m.isNotNull())).when(F.size(lines) > 0, lines).otherwise(F.filter(F.array(whole), lambda m: m.isNotNull()))
    rows = files.select("folder", "file", F.posexplode(maps).alias("line__", "m__"))
    pairs = rows.select("folder", "file", "line__", F.posexplode("m__").alias("place__", "orch_id", "value"))
    return pairs.groupBy("folder", "file", "orch_id").agg(F.max_by("value", F.struct("line__", "place__")).alias("value"))


def manifests(entries_: DataFrame) -> DataFrame:
    """(folder, years, schema_version, ui_uncertain_threshold, bit_order) of the manifests among entries."""
    own = entries_.where(F.col("file") == MANIFEST).groupBy("folder").agg(F.map_from_entries(F.collect_list(F.struct("orch_id", "value"))).alias("m"))
    value = lambda k: F.try_element_at("m", F.lit(k))
    return own.select("folder", F.from_json(value("years"), "array<int>").alias("years"), value("schema_version").try_cast("int").alias("schema_version"), value("ui_uncertain_threshold").try_cast("double").alias("ui_uncertain_threshold"), value("bit_order").alias("bit_order"))


def merged_manifest(manifests: DataFrame) -> DataFrame:
    """One manifest of several (folder, years, ...): the sorted union of years; other fields from the first folder."""
    others = [c for c in manifests.columns if c not in ("folder", "years")]
    return manifests.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("years")))).alias("years"), *[F.min_by(c, "folder").alias(c) for c in others])


def parse_keyed(documents: DataFrame, text: str, value_schema: str) -> DataFrame:
    """One row for each key of each JSON object in ``text``; what is no object is skipped."""
    keyed = F.from_json(F.col(text), f"map<string,struct<{value_schema}>>")
    rows = documents.withColumn("m__", keyed).where("m__ is not null")
    return rows.select(*[c for c in documents.columns if c != text], F.explode("m__").alias("orch_id", "value__")).select("*", "value__.*").drop("value__")


def merge_report(merged: DataFrame) -> DataFrame:
    """Per file: entities, sources and the size of the merged rows (file, folder, orch_id, bytes) in KB to one place."""
    return merged.groupBy("file").agg(F.count(F.lit(1)).alias("orchards"), F.countDistinct("folder").alias("n_sources"), F.bround(F.sum("bytes") / F.lit(1024.0), 1).alias("size_kb"))


def merge_log(state: DataFrame) -> DataFrame:
    """(folder, merged, n_files, file_hashes, last_merge): what a merge has taken in, a row a folder; file_hashes is JSON text of its files' hashes by name."""
    hashes = F.to_json(F.map_from_entries(F.array_sort(F.collect_set(F.struct("file", "hash")))))
    return state.groupBy("folder").agg(F.lit(True).alias("merged"), F.count_distinct("file").alias("n_files"), hashes.alias("file_hashes")).withColumn("last_merge", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def run_report(documents: DataFrame, files: DataFrame) -> DataFrame:
    """One row: the time, folders and files read, the merged files' statistics, their total size and most entities of a season, and the seasons in order.

    documents: (folder, file, orch_id, value); a file named by a year is a season. There is one struct a file: files are kinds and seasons, a handful.
    """
    sized = documents.withColumn("bytes", F.octet_length("orch_id") + F.octet_length("value") + F.lit(4))
    year = F.regexp_extract("file", r"^(\d{4})\.json$", 1).try_cast("int")
    stats = merge_report(sized).withColumn("year", year)
    summary = stats.agg(
        F.array_sort(F.collect_list(F.struct("file", "orchards", "n_sources", "size_kb"))).alias("files"), F.bround(F.sum("size_kb"), 1).alias("total_size_kb"),
        F.max(F.when(F.col("year").isNotNull(), F.col("orchards"))).alias("most_orchards"), F.array_sort(F.array_compact(F.collect_list("year"))).alias("years"),
    )
    read = files.agg(F.array_sort(F.collect_set("folder")).alias("folders"), F.count_distinct("folder", "file").alias("n_files"))
    return summary.crossJoin(read).withColumn("generated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
