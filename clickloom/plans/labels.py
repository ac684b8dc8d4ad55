"""Shape of reported metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAILY = "Day"


def labelled(rows: DataFrame, metric: str, masthead: str, *columns: str | Column) -> DataFrame:
    """Daily metric rows: constant labels, then ``columns``."""
    return rows.select(
        F.lit(DAILY).alias("grain"),
        F.lit(metric).alias("metric"),
        F.lit(masthead).alias("masthead"),
        *columns,
    )
