"""Raw clicks to sessionised clicks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.referers import RULES, referer_class
from clickloom.functions.timekeys import SYDNEY, iso_year, week_of_year
from clickloom.operators.reload import INDEX_CATEGORIES, reload_flags
from clickloom.operators.sessions import sessionise


#: Milliseconds of a week, and of the margin that covers any time zone.
WEEK_MS, MARGIN_MS = 7 * 86_400_000, 2 * 86_400_000


def months_of_week(week: int, year: int) -> list[str]:
    """The months (``MM-YYYY``, as click files are named) in which the ISO week has days."""
    days = (datetime.fromisocalendar(year, week, day) for day in range(1, 8))
    return list(dict.fromkeys(f"{day:%m-%Y}" for day in days))


def is_in_week(week: int, year: int | None = None, tz: str = SYDNEY) -> Column:
    """Whether ``timestamp`` is in the ISO week in local time, of any year unless ``year`` is given.

    With the year, a plain range around the week stands in front, by which files can be skipped.
    """
    at = F.col("timestamp")
    wanted = week_of_year(at, tz) == week
    if year is None:
        return wanted
    monday = datetime.fromisocalendar(year, week, 1).replace(tzinfo=timezone.utc)
    begin = int(monday.timestamp()) * 1000
    near = at.between(begin - MARGIN_MS, begin + WEEK_MS + MARGIN_MS)
    return near & wanted & (iso_year(at, tz) == year)


def in_week(clicks: DataFrame, week: int, year: int | None = None, tz: str = SYDNEY) -> DataFrame:
    """Clicks of one ISO week in local time, of any year unless ``year`` is given."""
    return clicks.where(is_in_week(week, year, tz))


def combine(*clicks: DataFrame) -> DataFrame:
    """All rows of several click sets; a field one set lacks is null there."""
    return reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), clicks)


def with_referer_class(
    clicks: DataFrame, rules: Sequence[tuple[str, str]] = RULES
) -> DataFrame:
    return clicks.withColumn("finalReferer", referer_class(F.col("referer"), F.col("url"), rules))


def sessionised_clicks(
    clicks: DataFrame,
    categories: Mapping[str, str] = INDEX_CATEGORIES,
    across_sites: bool = True,
    rules: Sequence[tuple[str, str]] = RULES,
    salt: str = "",
    tz: str = SYDNEY,
) -> DataFrame:
    """Drop automatic reloads, form sessions, classify referers.

    Mastheads not in ``categories`` keep all their views.  Sessions run across
    mastheads, or stay within each of them.
    """
    flags = reload_flags(clicks, categories, salt)
    scope = [] if across_sites else ["masthead"]
    return with_referer_class(sessionise(clicks, scope=scope, reloads=flags, tz=tz), rules)
