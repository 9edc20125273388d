"""Storage reports and compaction of Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.functions.text import readable_size
from tallyframe.operators.joins import join_on
from tallyframe.sources.tables import inline_rows

TARGET_FILE_BYTES = 512 * 1024 * 1024


def _files(spark: SparkSession, name: str, path: str) -> DataFrame:
    return spark.read.parquet(path).select(
        F.lit(name).alias("table_name"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
    )


def storage_report(spark: SparkSession, paths: Mapping[str, str], like: str | None = None) -> DataFrame:
    """Files, bytes, rows and readable size per table, read from file metadata and row-group counts.

    ``like`` keeps the tables whose name matches a LIKE pattern. A table without
    rows is reported as empty.
    """
    rows = reduce(DataFrame.unionByName, [_files(spark, name, path) for name, path in paths.items()])
    sizes = (
        rows.groupBy("table_name", "file", "size")
        .agg(F.count("*").alias("n"))
        .groupBy("table_name")
        .agg(F.count("file").alias("files"), F.sum("size").alias("total_bytes"), F.sum("n").alias("row_count"))
    )
    named = join_on(inline_rows(spark, [(name,) for name in paths], "table_name string"), sizes, ["table_name"], "left")
    if like is not None:
        named = named.filter(F.col("table_name").like(like))
    known = {name: F.coalesce(name, F.lit(0)) for name in ("files", "total_bytes", "row_count")}
    return named.withColumns(known).withColumn("total", readable_size(F.col("total_bytes")))


def table_bytes(spark: SparkSession, path: str) -> int:
    """The table's size on disk; one number comes back to the driver."""
    return storage_report(spark, {"table": path}).first().total_bytes


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Rewrite a table into files of about ``file_bytes`` each and return the new table.

    Neighbouring splits are merged into one task each: nothing is shuffled, rows
    stay in their order and compress as before.
    """
    files = max(1, -(-table_bytes(spark, source) // file_bytes))
    spark.read.parquet(source).coalesce(files).write.mode("errorifexists").parquet(target)
    return spark.read.parquet(target)
