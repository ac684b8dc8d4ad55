"""Time spent on each view: until the next view of the same session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.timekeys import SYDNEY, day_of_month
from clickloom.operators.slots import SLOT_MS, with_next_timestamp


def view_dwell(
    sessionised: DataFrame,
    item: str = "assetCategory",
    session_key: str = "sessionStart",
    slot_ms: int = SLOT_MS,
    tz: str = SYDNEY,
) -> DataFrame:
    """``day, item, dwellMs`` for views followed by another in the day's session.

    Views are ordered by timestamp and then item.  Several equal views at one
    instant are one row here: all but the last dwell 0 ms.
    """
    views = (
        sessionised.select(
            day_of_month(F.col("timestamp"), tz).alias("day"),
            session_key,
            "timestamp",
            F.coalesce(item, F.lit("")).alias(item),
        )
        .groupBy("day", session_key, "timestamp", item)
        .agg(F.count("*").alias("_views"))
    )
    followed = with_next_timestamp(views, ["day", session_key], [item], slot_ms)
    dwell = F.coalesce(F.col("nextTimestamp") - F.col("timestamp"), F.lit(0))
    return followed.where(F.col("nextTimestamp").isNotNull() | (F.col("_views") > 1)).select(
        "day", item, dwell.cast("bigint").alias("dwellMs")
    )


def dwell_by(sessionised: DataFrame, item: str = "assetCategory", **options) -> DataFrame:
    """Total dwell per day and item."""
    return (
        view_dwell(sessionised, item, **options)
        .groupBy("day", item)
        .agg(F.sum("dwellMs").alias("dwellMs"))
    )
