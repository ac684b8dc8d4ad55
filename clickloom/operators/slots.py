"""Ordered work on long time series, one time slot at a time.

A window over everything one visitor did is a single task, however many rows
that visitor has.  Cutting the series into fixed slots bounds it: within a slot
there are at most ``slot_ms`` distinct instants, and a series has one summary
row per slot it touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_MS = 600_000


def slot_of(ms: Column, slot_ms: int = SLOT_MS) -> Column:
    return F.call_function("div", ms - F.pmod(ms, F.lit(slot_ms).cast("bigint")), F.lit(slot_ms).cast("bigint"))


def with_next_timestamp(
    rows: DataFrame,
    keys: Sequence[str],
    ties: Sequence[str] = (),
    slot_ms: int = SLOT_MS,
) -> DataFrame:
    """Add ``nextTimestamp``: the timestamp of the following row of the same key.

    The same as ``lead`` over the whole key, ordered by ``timestamp`` and then
    ``ties``; null on the key's last row.  ``rows`` should be distinct.
    """
    slotted = rows.withColumn("_slot", slot_of(F.col("timestamp"), slot_ms))
    inside = Window.partitionBy(*keys, "_slot").orderBy("timestamp", *ties)
    along = Window.partitionBy(*keys).orderBy("_slot")
    following = (
        slotted.groupBy(*keys, "_slot")
        .agg(F.min("timestamp").alias("_first"))
        .select(*keys, "_slot", F.lead("_first").over(along).alias("_nextSlot"))
    )
    return (
        slotted.withColumn("_inside", F.lead("timestamp").over(inside))
        .join(following, [*keys, "_slot"])
        .withColumn("nextTimestamp", F.coalesce("_inside", "_nextSlot"))
        .drop("_slot", "_inside", "_nextSlot")
    )
