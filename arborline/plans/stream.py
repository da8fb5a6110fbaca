"""Merging as files come: a file stream that runs until what is there is read, and a table of entries that each batch adds to.

A batch parses its files and writes their entries under its own number, over what an attempt before may have left; so a batch that is repeated changes nothing, and one that
failed is repeated whole. The checkpoint folder knows which files were read. Documents are the entries of each file's last batch, merged key by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborline.operators import merging
from arborline.sources import documents, readers

ENTRIES = "folder string, file string, hash string, orch_id string, value string"
_FILES = "path string, modificationTime timestamp, length long, content binary"


def _named(files: DataFrame) -> DataFrame:
    """(folder, file, hash, content) of the stream's files, without skipped folders."""
    part = lambda k: F.regexp_extract("path", readers.DOCUMENT, k)
    named = files.where(F.col("path").rlike(readers.DOCUMENT) & (F.col("length") > 0)).select(part(1).alias("folder"), part(3).alias("file"), F.md5("content").alias("hash"), "content")
    return named.where(~F.col("folder").startswith(".") & ~F.lower("folder").isin(*readers.SKIPPED))


def entries_of_last_batches(spark: SparkSession, out: str) -> DataFrame:
    """(folder, file, hash, orch_id, value, batch): of each file the entries of the last batch that read it; a row with a null orch_id stands for a file without keys."""
    every = readers.parquet_or_none(spark, f"{out}/entries")
    if every is None:
        return spark.createDataFrame([], ENTRIES + ", batch int")
    last = every.groupBy("folder", "file").agg(F.max("batch").alias("last__")).withColumnsRenamed({"folder": "folder__", "file": "file__"})
    kept = every.join(last, (every.folder == last["folder__"]) & (every.file == last["file__"]) & (every.batch == last["last__"]))
    return kept.select(*every.columns)


def merged(spark: SparkSession, out: str) -> DataFrame:
    """(folder, file, orch_id, value): of the entries that share a file and key that of the last folder by name."""
    rows = entries_of_last_batches(spark, out).where("orch_id is not null").select("folder", "file", "orch_id", "value")
    return merging.upsert(rows, ["file", "orch_id"], "folder")


def follow(spark: SparkSession, root: str, out: str, files_a_batch: int = 1000) -> int:
    """Read the JSON files below root that no run before has read, in batches, and write the merged documents; the number of documents.

    Files are known by their paths: to replace one, add it under a folder of a later name, or merge by content hash with plans.run.merge. A file that comes again with a
    hash that is known adds nothing.
    """

    def add(files: DataFrame, number: int) -> None:
        here = files.sparkSession
        named = _named(files).persist()
        try:
            known = entries_of_last_batches(here, out).where(F.col("batch") != number).select("folder", "file", "hash").distinct()
            fresh = merging.changed_files(named, known)
            keyed = merging.entries(fresh)
            hashes = fresh.select("folder", "file", "hash").distinct()
            rows = hashes.join(keyed, ["folder", "file"], "left").select("folder", "file", "hash", "orch_id", "value")
            rows.write.mode("overwrite").parquet(f"{out}/entries/batch={number}")
        finally:
            named.unpersist()

    stream = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_a_batch).load(root)
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{out}/checkpoint").foreachBatch(add).start()
    query.awaitTermination()
    return documents.write_documents(merged(spark, out).where(F.col("file") != merging.MANIFEST), "file", "orch_id", "value", f"{out}/merged")
