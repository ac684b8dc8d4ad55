"""Find and drop homepage views caused by automatic page reloads."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.reloads import is_reload, reload_probability
from clickloom.operators.sessions import RELOAD_KEY
from clickloom.operators.slots import SLOT_MS, with_next_timestamp

# The asset category of each reloading homepage.
INDEX_CATEGORIES = {
    "smh": "The Sydney Morning Herald",
    "theage": "The Age",
}


def index_views(
    clicks: DataFrame, categories: Mapping[str, str] = INDEX_CATEGORIES
) -> DataFrame:
    """Homepage views of the mastheads in ``categories``."""
    homepage = reduce(
        lambda either, one: either | one,
        (
            (F.col("masthead") == masthead) & (F.col("assetCategory") == category)
            for masthead, category in categories.items()
        ),
        F.lit(False),
    )
    return clicks.where((F.col("assetType") == "Index") & homepage)


def index_gaps(views: DataFrame, slot_ms: int = SLOT_MS) -> DataFrame:
    """Each instant a visitor saw a homepage, with the time to their next one.

    Views of one visitor at the same instant are one row: only the last of them
    has a gap at all, and a flag would apply to all of them alike.  A visitor's
    last view has gap 0.
    """
    moments = views.select(
        "masthead", F.coalesce("trackingId", F.lit("")).alias("trackingId"), "timestamp"
    ).distinct()
    paired = with_next_timestamp(moments, ["masthead", "trackingId"], slot_ms=slot_ms)
    gap = F.coalesce(F.col("nextTimestamp") - F.col("timestamp"), F.lit(0))
    return paired.withColumn("gap", gap.cast("bigint")).drop("nextTimestamp")


def with_reload_probability(gaps: DataFrame) -> DataFrame:
    return gaps.withColumn("probability", reload_probability(F.col("gap")))


def reload_flags(
    clicks: DataFrame,
    categories: Mapping[str, str] = INDEX_CATEGORIES,
    salt: str = "",
    slot_ms: int = SLOT_MS,
) -> DataFrame:
    """The (masthead, visitor, instant) triples taken to be automatic reloads.

    The earlier view of a pair is the one flagged.
    """
    scored = with_reload_probability(index_gaps(index_views(clicks, categories), slot_ms))
    drawn = is_reload(F.col("probability"), F.col("trackingId"), F.col("timestamp"), salt)
    return scored.where(drawn).select(*RELOAD_KEY)


def remove_reloads(clicks: DataFrame, flags: DataFrame) -> DataFrame:
    """Drop every click at a flagged instant, homepage view or not."""
    keyed = clicks.withColumn("trackingId", F.coalesce("trackingId", F.lit("")))
    return keyed.join(flags, list(RELOAD_KEY), "left_anti")
