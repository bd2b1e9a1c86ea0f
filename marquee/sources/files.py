"""CSV exchange with other systems, and table writes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_TEXT = "\\N"


def write_csv(df: DataFrame, path: str, quoted: bool = False, single_file: bool = False) -> None:
    """Headered CSV, replaced on each run; a folder of files, one from each task.

    ``single_file=True`` is for the small feature extracts whose agreed format is one file:
    the rows meet in one task for the write alone.
    """
    out = df.repartition(1) if single_file else df
    writer = out.write.mode("overwrite").option("header", True).option("nullValue", NULL_TEXT)
    writer.option("quote", '"' if quoted else "").option("compression", "none").csv(path)


def read_csv_folder(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    key: str | None = None,
    excluded_keys: Iterable[str] = (),
    drop_empty: bool = True,
) -> DataFrame:
    """Every CSV under a folder: lower-case names, empty columns and listed keys dropped."""
    reader = spark.read.option("header", True).option("nullValue", NULL_TEXT)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    df = reader.csv(path)
    df = df.toDF(*[c.lower().replace("'", "") for c in df.columns])
    excluded = list(excluded_keys)
    if key and excluded:
        df = df.where(~F.col(key).isin(*excluded) | F.col(key).isNull())
    return drop_empty_columns(df) if drop_empty else df


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """One aggregate over the table finds the columns without a value."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] > 0])


def load_by_position(
    spark: SparkSession, path: str, schema: str, loaded_at: str | None = None
) -> DataFrame:
    """Columns by position, empty text as null, unreadable rows skipped."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("nullValue", "")
        .option("mode", "DROPMALFORMED")
        .csv(path)
    )
    if loaded_at is None:
        return df
    return df.withColumn("last_update_timestamp", F.lit(loaded_at).cast("timestamp"))


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrites only the partitions present in ``df``."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
