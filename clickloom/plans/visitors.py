"""Weekly and daily visitor metrics, from session heads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.timekeys import SYDNEY, day_of_month, week_of_year

# Metric -> (weekly label, daily label).
LABELS = {
    "visitors": ("Week_visitor", "Daily_visitors"),
    "visits": ("Week_visit", "Daily_visit"),
    "numpage": ("Week_numpage", "Daily_numpage"),
    "session": ("Week_session", "Daily_session"),
    "bounce": ("Week_bounce", "Daily_bounce"),
    "repeat": ("Week_repeat", "Daily_repeat"),
}
PER_VISITOR = {"visitors", "repeat"}


def _partials() -> dict[str, Column]:
    pages, seconds = F.col("numPage"), F.col("sessionDuration")
    return {
        "_visits": F.count("*"),
        "_pages": F.sum(F.when(pages != 1, pages)),
        "_paged": F.count_if(pages != 1),
        "_seconds": F.sum(F.when(seconds != 0, seconds)),
        "_timed": F.count_if(seconds != 0),
        "_bounces": F.count_if(pages == 1),
    }


# Metric -> the partial sums it is made of.
NEEDS = {
    "visitors": (),
    "visits": ("_visits",),
    "numpage": ("_pages", "_paged"),
    "session": ("_seconds", "_timed"),
    "bounce": ("_bounces",),
    "repeat": ("_visits",),
}


def _value(metric: str) -> Column:
    """The metric over a period's visitor rows; null where it has no row."""
    if metric == "visitors":
        return F.count("*")
    if metric == "visits":
        return F.sum("_visits")
    if metric == "numpage":
        return F.sum("_pages") / F.nullif(F.sum("_paged"), F.lit(0))
    if metric == "session":
        return F.sum("_seconds") / F.nullif(F.sum("_timed"), F.lit(0))
    if metric == "bounce":
        return F.nullif(F.sum("_bounces"), F.lit(0))
    if metric == "repeat":
        return F.nullif(F.count_if(F.col("_visits") > 1), F.lit(0))
    raise ValueError(f"unknown metric {metric!r}")


def visitor_metrics(
    heads: DataFrame,
    masthead: str,
    metrics: Sequence[str] = tuple(LABELS),
    tz: str = SYDNEY,
) -> DataFrame:
    """``metric, masthead, period, value`` per week and per day, in one pass.

    Means leave out single-page visits (pages) and zero durations (seconds);
    a period with nothing to report has no row.
    """
    at = F.col("timestamp")
    dated = heads.select(
        week_of_year(at, tz).alias("week"),
        day_of_month(at, tz).alias("day"),
        "trackingId",
        "numPage",
        "sessionDuration",
    )
    visitor = [F.col("trackingId")] if PER_VISITOR & set(metrics) else []
    wanted = {name for metric in metrics for name in NEEDS[metric]} or {"_visits"}
    sums = [total.alias(name) for name, total in _partials().items() if name in wanted]
    by_visitor = dated.groupingSets(
        [[F.col("week"), *visitor], [F.col("day"), *visitor]],
        F.col("week"), F.col("day"), *visitor,
    ).agg(F.grouping("day").alias("_weekly"), *sums)
    by_period = by_visitor.groupBy(
        "_weekly", F.when(F.col("_weekly") == 1, F.col("week")).otherwise(F.col("day")).alias("period")
    ).agg(*[_value(metric).cast("double").alias(metric) for metric in metrics])

    rows = [
        F.struct(
            F.when(F.col("_weekly") == 1, LABELS[metric][0]).otherwise(LABELS[metric][1]).alias("metric"),
            F.col(metric).alias("value"),
        )
        for metric in metrics
    ]
    return (
        by_period.select("period", F.inline(F.array(*rows)))
        .where(F.col("value").isNotNull())
        .select("metric", F.lit(masthead).alias("masthead"), "period", "value")
    )
