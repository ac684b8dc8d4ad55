"""Calendar keys of an epoch-millisecond column in a chosen time zone.

Local times are zone-less timestamps, so no result depends on
``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SYDNEY = "Australia/Sydney"


def local_time(ms: Column, tz: str = SYDNEY) -> Column:
    """Wall-clock time (``timestamp_ntz``) in ``tz``."""
    shifted = F.unix_micros(F.from_utc_timestamp(F.timestamp_millis(ms), tz))
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + shifted * F.expr(
        "interval '0.000001' second"
    )


def local_date(ms: Column, tz: str = SYDNEY) -> Column:
    return local_time(ms, tz).cast("date")


def week_of_year(ms: Column, tz: str = SYDNEY) -> Column:
    """ISO week number; weeks start on Monday."""
    return F.weekofyear(local_time(ms, tz))


def iso_year(ms: Column, tz: str = SYDNEY) -> Column:
    """The year the ISO week belongs to: the year of the week's Thursday."""
    local = local_date(ms, tz)
    return F.year(F.date_add(local, F.lit(3) - F.weekday(local)))


def day_of_month(ms: Column, tz: str = SYDNEY) -> Column:
    return F.dayofmonth(local_time(ms, tz))


def is_weekend(ms: Column, tz: str = SYDNEY) -> Column:
    return F.weekday(local_time(ms, tz)) >= 5


def day_key(ms: Column, tz: str = SYDNEY) -> Column:
    """``"<day of year> ' <year>"``."""
    local = local_time(ms, tz)
    return F.concat_ws(" ' ", F.dayofyear(local).cast("string"), F.year(local).cast("string"))


def month_key(ms: Column, tz: str = SYDNEY) -> Column:
    """``"<month>-<year>"`` with January as month 0."""
    local = local_time(ms, tz)
    return F.concat_ws("-", (F.month(local) - 1).cast("string"), F.year(local).cast("string"))


def month_start(ms: Column, tz: str = SYDNEY) -> Column:
    """First date of the local month."""
    return F.trunc(local_date(ms, tz), "month")
