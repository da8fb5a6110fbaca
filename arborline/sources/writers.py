"""Writers of tables, season shards and keyed JSON documents. All write folders that Spark's readers read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, only_if_rows: bool = False) -> bool:
    """Write with a header; with only_if_rows an empty table writes nothing."""
    if only_if_rows and df.isEmpty():
        return False
    df.write.mode("overwrite").csv(path, header=True)
    return True


def write_shards(attributes: DataFrame, path: str) -> None:
    """One folder a season, in a single pass."""
    attributes.write.mode("overwrite").partitionBy("season_sort").csv(path, header=True)


def keyed_entries(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, key, entry): one ``"key":{...}`` text a row, nulls included; commas and braces make those of one ``by`` one document."""
    others = [c for c in df.columns if c != key and c not in by]
    quoted = F.to_json(F.array(F.col(key).cast("string")))
    name = F.substring(quoted, F.lit(2), F.length(quoted) - F.lit(2))
    return df.select(*by, key, F.concat(name, F.lit(":"), F.to_json(F.struct(*others), {"ignoreNullFields": "false"})).alias("entry"))


def write_keyed_lines(df: DataFrame, key: str, path: str) -> None:
    """Keyed documents of any size, as JSON lines of one-key objects."""
    keyed_entries(df, key).select(F.concat(F.lit("{"), F.col("entry"), F.lit("}")).alias("value")).write.mode("overwrite").text(path)


def write_raw_keyed_files(df: DataFrame, key: str, value: str, file: str, path: str) -> None:
    """For each ``file`` a folder of JSON lines of one-key objects, in one pass; value is JSON text already. A large file's rows are dealt by key."""
    quoted = F.to_json(F.array(F.col(key).cast("string")))
    name = F.substring(quoted, F.lit(2), F.length(quoted) - F.lit(2))
    lines = df.select(F.concat(F.lit("{"), name, F.lit(":"), F.coalesce(F.col(value), F.lit("null")), F.lit("}")).alias("value"), F.col(file).alias("file"))
    lines.write.mode("overwrite").partitionBy("file").text(path)


def keyed_values(df: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """(by, key, value): the other columns as JSON text, nulls included."""
    others = [c for c in df.columns if c != key and c not in by]
    return df.select(*by, key, F.to_json(F.struct(*others), {"ignoreNullFields": "false"}).alias("value"))


def write_text_row(spark: SparkSession, text: str, path: str) -> None:
    """One line of text, such as a model as JSON."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def copy_text(spark: SparkSession, source: str, path: str) -> None:
    """A small text file or folder of one, as it is."""
    spark.read.text(source).coalesce(1).write.mode("overwrite").text(path)


def write_json_row(df: DataFrame, path: str) -> None:
    """A one-row table, such as a manifest, a model or a report, as one JSON text."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)
