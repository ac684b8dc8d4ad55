"""Monthly visits and page views of one country's visitors, by device."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.timekeys import SYDNEY, month_key, month_start
from clickloom.operators.geo import in_country, locate_addresses, with_address
from clickloom.operators.sessions import session_heads, sessionise
from clickloom.staging import stage

OVERALL = "overall"
MONTH = ("device", "site", "month", "month_start")


def device_sessions(clicks: DataFrame, ip_col: str = "IpAddress", tz: str = SYDNEY) -> DataFrame:
    """Heads of day-bounded sessions, once overall and once per device.

    Overall sessions join both devices' views, so they are formed separately:
    each click counts in two scopes of the same plan.
    """
    scopes = F.array_distinct(F.array(F.lit(OVERALL), F.coalesce("device", F.lit(OVERALL))))
    scoped = clicks.select(
        "trackingId", "timestamp", "site", ip_col, F.explode(scopes).alias("scope")
    )
    return session_heads(sessionise(scoped, scope=["scope"], by_day=True, tz=tz))


def monthly_metrics(
    heads: DataFrame,
    ranges: DataFrame,
    masthead: str,
    country: str = "AU",
    ip_col: str = "IpAddress",
    default_ip: str | None = None,
    tz: str = SYDNEY,
) -> DataFrame:
    """``Month_visit`` and ``Month_pageviews`` rows per device scope, site and month.

    Visits are added up per address before the addresses are located, so each
    address is looked up once per group and no visit is joined to anything.
    The sums are staged (see ``staging.stage``): they are read for the addresses and for the
    join with what these are, and ``heads`` would be worked out for each.
    """
    at = F.col("timestamp")
    per_address = (
        with_address(heads, ip_col, default_ip)
        .groupBy(
            F.col("scope").alias("device"),
            F.coalesce("site", F.lit("")).alias("site"),
            month_key(at, tz).alias("month"),
            month_start(at, tz).alias("month_start"),
            "address",
        )
        .agg(F.count("*").alias("_visits"), F.sum("numPage").alias("_pages"))
    )
    totals = (
        in_country(locate_addresses(stage(per_address, "visits-per-address"), ranges), country)
        .groupBy(*MONTH)
        .agg(F.sum("_visits").alias("_visits"), F.sum("_pages").alias("_pages"))
    )
    rows = F.array(
        F.struct(F.lit("Month_visit").alias("metric"), F.col("_visits").cast("double").alias("value")),
        F.struct(F.lit("Month_pageviews").alias("metric"), F.col("_pages").cast("double").alias("value")),
    )
    return totals.select(*MONTH, F.inline(rows)).select(
        "metric", F.lit(masthead).alias("masthead"), F.lit("Overall").alias("label"), *MONTH, "value"
    )
