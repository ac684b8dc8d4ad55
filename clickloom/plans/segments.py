"""Visitor features, cookie clearers and visitor segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.timekeys import SYDNEY, is_weekend, local_date
from clickloom.operators.ranking import top_per_group

UNFLAGGED = "UNFLAGGED"
NOT_A_MEMBER = "0"
FEWEST_IDS, MOST_IDS = 2, 5


def visit_depth(pages: Column) -> Column:
    return F.when(pages <= 1, "SINGLE").when(pages <= 4, "2-4 PAGES").otherwise(">4 PAGES")


def visitor_features(heads: DataFrame, tz: str = SYDNEY) -> DataFrame:
    """One row per visitor: how often, when and how deeply they visited.

    A visitor without single-page homepage visits has ``indexSessions`` -1.
    """
    at = F.col("timestamp")
    visits = heads.select(
        "trackingId",
        local_date(at, tz).alias("date"),
        is_weekend(at, tz).alias("weekend"),
        visit_depth(F.col("numPage")).alias("depth"),
        (F.coalesce("assetType", F.lit("")) == "Index").alias("index"),
    )
    single = F.col("depth") == "SINGLE"
    features = visits.groupBy("trackingId").agg(
        F.count("*").alias("sessions"),
        F.count_if("weekend").alias("weekendSessions"),
        F.count_if(~F.col("weekend")).alias("weekdaySessions"),
        F.count_if(single & F.col("index")).alias("indexSessions"),
        F.count_if(single).alias("singleSessions"),
        F.count_if(F.col("depth") == "2-4 PAGES").alias("middleSessions"),
        F.count_if(F.col("depth") == ">4 PAGES").alias("deepSessions"),
        F.count_distinct("date").alias("activeDays"),
    )
    return features.withColumn(
        "indexSessions", F.coalesce(F.nullif("indexSessions", F.lit(0)), F.lit(-1).cast("bigint"))
    )


def _sharers(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Visitors who share ``keys`` with few others.

    One id more than the limit is enough to rule a group out, so no group
    brings more rows than that to a task.
    """
    shared = (
        top_per_group(pairs.distinct(), keys, "trackingId", [], MOST_IDS + 1)
        .groupBy(*keys)
        .agg(F.collect_list("trackingId").alias("_ids"))
    )
    few = F.size("_ids").between(FEWEST_IDS, MOST_IDS)
    return shared.where(few).select(F.explode("_ids").alias("trackingId"))


def cookie_clearers(
    clicks: DataFrame,
    member_col: str = "memberId",
    ip_col: str = "IpAddress",
    agent_col: str = "userAgent",
) -> DataFrame:
    """Visitors that look like one person who clears cookies.

    They share a member id, or an address and user agent, with one to four
    other visitor ids.
    """
    member = clicks.select(F.coalesce(member_col, F.lit("")).alias("_member"), "trackingId")
    machine = clicks.select(
        F.coalesce(ip_col, F.lit("")).alias("_ip"),
        F.coalesce(agent_col, F.lit("")).alias("_agent"),
        "trackingId",
    )
    by_member = _sharers(member.where(F.col("_member") != NOT_A_MEMBER), ["_member"])
    by_machine = _sharers(machine, ["_ip", "_agent"])
    return by_member.unionByName(by_machine).distinct()


# The segments' names and thresholds.
def segment_rules() -> list[tuple[Column, str]]:
    """The segments in the order they are tried."""
    visits, pages_1 = F.col("sessions"), F.col("singleSessions")
    pages_2, pages_5 = F.col("middleSessions"), F.col("deepSessions")
    weekend_share = F.col("weekendSessions") / visits
    index_share = F.col("indexSessions") / visits
    mixed_week = (weekend_share > 0.2) & (weekend_share < 0.8)
    reads_on = pages_2 + pages_5 > pages_1
    spread = F.col("activeDays") >= 3
    habitual = mixed_week & spread & reads_on
    again = visits > 1
    return [
        ((visits > 5) & habitual & (pages_5 > pages_2), "HABITUAL ENGAGED VISITORS"),
        (again & (visits < 6) & habitual, "HABITUAL NON-ENGAGED VISITORS"),
        (again & (F.col("indexSessions") != -1) & (index_share > 0.5), "UNENGAGED VISITORS"),
        ((visits == 1) & ~F.col("cookieClearer"), "VISITORS BY CHANCE"),
        ((visits == 1) & F.col("cookieClearer"), "COOKIE CLEARER"),
        (again & (weekend_share >= 0.8), "AT HOME READERS"),
        (again & (weekend_share <= 0.2), "AT OFFICE READERS"),
        (again & (pages_1 + pages_2 > pages_5) & (index_share <= 0.5), "MISSION READERS"),
        ((visits > 5) & (F.col("activeDays") < 3), "EVENT READERS"),
    ]


def visitor_segments(features: DataFrame, clearers: DataFrame) -> DataFrame:
    """Features plus ``cookieClearer`` and the visitor's ``segment``."""
    known = clearers.select("trackingId", F.lit(True).alias("cookieClearer"))
    flagged = features.join(known, "trackingId", "left").withColumn(
        "cookieClearer", F.coalesce("cookieClearer", F.lit(False))
    )
    segment = F.when(F.lit(False), UNFLAGGED)
    for rule, name in segment_rules():
        segment = segment.when(rule, name)
    return flagged.withColumn("segment", segment.otherwise(UNFLAGGED))


def flag_heads(heads: DataFrame, segments: DataFrame) -> DataFrame:
    """Session heads with their visitor's segment as ``repeatFlag``."""
    flags = segments.select("trackingId", F.col("segment").alias("repeatFlag"))
    return heads.join(flags, "trackingId", "left").withColumn(
        "repeatFlag", F.coalesce("repeatFlag", F.lit(UNFLAGGED))
    )


def segment_trend(heads: DataFrame, segments: DataFrame, tz: str = SYDNEY) -> DataFrame:
    """Distinct visitors per segment and local date, with the date's day of month."""
    dates = heads.select("trackingId", local_date(F.col("timestamp"), tz).alias("date")).distinct()
    # Visitors are distinct within a date already, so counting rows is enough.
    return (
        flag_heads(dates, segments)
        .groupBy("repeatFlag", "date")
        .agg(F.count("*").alias("visitors"))
        .select("repeatFlag", "date", F.dayofmonth("date").alias("day"), "visitors")
    )
