"""A sample of texts whose size does not grow with the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sample_texts(rows: DataFrame, size: int, by: str | None = None) -> DataFrame:
    """About ``size`` distinct rows with a ``text`` that is not NULL: those whose text's hash lies below ``size`` / rows of its range.

    Every row has the same chance, copies count once, and the choice is the same in every run. Fewer than ``size`` rows are all taken.
    With ``by`` the size is that for each value of a column of few values, none of them NULL; their counts pass through the driver.
    """
    rows = rows.where(F.col("text").isNotNull())
    span = 1 << 31
    if by is None:
        many = rows.count()
        bound = F.lit(int(size / many * span)) if many > size else None
    else:
        counts = rows.groupBy(by).count().collect()
        bounds = [F.lit(x) for value, many in counts if many > size for x in (value, int(size / many * span))]
        bound = F.coalesce(F.create_map(*bounds)[F.col(by)], F.lit(span)) if bounds else None
    if bound is not None:
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(span)) < bound)
    return rows.dropDuplicates()
