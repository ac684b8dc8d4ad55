"""Top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    rows: DataFrame, group: Sequence[str], score: str, ties: Sequence[str], k: int = 10
) -> DataFrame:
    """The ``k`` highest scores of each group, ties broken by ``ties``.

    Spark keeps only ``k`` rows per group in each task before it shuffles.
    """
    best_first = Window.partitionBy(*group).orderBy(F.desc(score), *ties)
    return rows.withColumn("_rank", F.row_number().over(best_first)).where(
        F.col("_rank") <= k
    ).drop("_rank")
