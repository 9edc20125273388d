"""The planner's own size estimate, used before any choice that depends on a side being small."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark would broadcast ``df`` by its own threshold."""
    return estimated_bytes(df) <= broadcast_limit(df)
