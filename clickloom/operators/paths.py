"""The order in which sessions move between sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.sites import brand_of_site, collapse_repeats, first_steps
from clickloom.functions.timekeys import SYDNEY, day_of_month
from clickloom.operators.slots import SLOT_MS, slot_of

PATH_LENGTH = 5


def session_paths(
    sessionised: DataFrame,
    length: int = PATH_LENGTH,
    slot_ms: int = SLOT_MS,
    tz: str = SYDNEY,
) -> DataFrame:
    """``day, sessionId, path``: the first ``length`` site changes of each day's session.

    Within a slot only the first ``length`` changes can matter: they alone fill
    the path, so whatever follows them in that slot cannot appear in it.  That
    leaves a few rows per slot to collect for a session.
    """
    keys = ["day", "sessionId"]
    stops = sessionised.select(
        day_of_month(F.col("timestamp"), tz).alias("day"),
        "sessionId",
        slot_of(F.col("timestamp"), slot_ms).alias("_slot"),
        "timestamp",
        brand_of_site(F.coalesce("site", F.lit(""))).alias("site"),
    ).distinct()
    in_slot = Window.partitionBy(*keys, "_slot").orderBy("timestamp", "site")
    changes = (
        stops.withColumn("_before", F.lag("site").over(in_slot))
        .where(F.col("_before").isNull() | (F.col("_before") != F.col("site")))
        .withColumn("_nth", F.row_number().over(in_slot))
        .where(F.col("_nth") <= length)
    )
    ordered = F.array_sort(F.collect_list(F.struct("timestamp", "site")))
    return (
        changes.groupBy(*keys)
        .agg(ordered.alias("_stops"))
        .withColumn("_sites", F.col("_stops.site"))
        .select(*keys, first_steps(collapse_repeats(F.col("_sites")), length).alias("path"))
    )


def brand_paths(sessionised: DataFrame, **options) -> DataFrame:
    """Sessions per day and path."""
    return (
        session_paths(sessionised, **options)
        .groupBy("day", "path")
        .agg(F.count("*").alias("sessions"))
    )
