"""Dense numbering without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.session import scratch_path
from tallyframe.sources.tables import create_table


def number_rows(df: DataFrame, name: str, order: Sequence[Column] = (), start: Column | int = 1) -> DataFrame:
    """Add a dense row number.

    Rows are range-sorted by ``order`` (a total order) or left as they lie, and
    written to the shared folder, which fixes each row's place even when tasks
    are retried. A row's number is its place in its file plus the rows in the
    files before it. Only one row count per file meets in one task.
    """
    path = scratch_path(df.sparkSession, "numbered")
    placed = create_table(df.orderBy(*order) if order else df, path)
    # Files are named part-<partition>-..; partitions of a sorted table follow its order.
    part = F.split_part(F.col("_metadata.file_name"), F.lit("-"), F.lit(2)).cast("bigint")
    before = Window.orderBy("_part", "_file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: the bound for both the window and the broadcast.
    offsets = (
        placed.select(part.alias("_part"), F.col("_metadata.file_name").alias("_file"))
        .groupBy("_part", "_file")
        .agg(F.count("*").alias("_n"))
        .select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    rows = placed.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_seat")
    ).join(F.broadcast(offsets), "_file")
    first = start if isinstance(start, Column) else F.lit(start)
    number = (F.col("_seat") + F.col("_offset") + first).cast("bigint")
    return rows.select(*placed.columns, number.alias(name))
