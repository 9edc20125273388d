"""Tables partitioned by month: written, reloaded month by month, and read by period."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MONTH = "month"


def month_of(day: Column) -> Column:
    """The first day of a date's month."""
    return F.trunc(day.cast("date"), "month")


def _by_month(df: DataFrame, day: str) -> DataFrame:
    # Rebalanced rather than dealt by month: a month with very many rows is split over several tasks and files.
    return df.withColumn(MONTH, month_of(F.col(day))).hint("rebalance", MONTH)


def create_by_month(df: DataFrame, path: str, day: str) -> DataFrame:
    """Write ``df`` as a new table with one folder for each month of ``day``; rows without a day have a folder of their own."""
    _by_month(df, day).write.mode("errorifexists").partitionBy(MONTH).parquet(path)
    return read_by_month(df.sparkSession, path)


def reload_months(batch: DataFrame, path: str, day: str) -> DataFrame:
    """Replace the months that the batch has rows of, and leave the files of all others as they are.

    The same batch again gives the same table. The batch must not read from ``path`` itself: its files are replaced.
    """
    target = read_by_month(batch.sparkSession, path)
    aligned = batch.select(*[F.col(f.name).cast(f.dataType) for f in target.schema if f.name != MONTH])
    _by_month(aligned, day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    return read_by_month(batch.sparkSession, path)


def read_by_month(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def within(day: str, start: dt.date | None, end: dt.date | None) -> Column:
    """Days from ``start`` on and before ``end``; only the months that can hold them are read. An unknown bound meets nothing."""
    if start is None or end is None:
        return F.lit(False)
    exact = (F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end))
    return (F.col(MONTH) >= F.lit(start.replace(day=1))) & (F.col(MONTH) < F.lit(end)) & exact
