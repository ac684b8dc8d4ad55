"""Group each visitor's page views into sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.timekeys import SYDNEY, day_key, local_date
from clickloom.operators.slots import SLOT_MS, slot_of

GAP_MS = 1_800_000
RELOAD_KEY = ("masthead", "trackingId", "timestamp")


def session_slots(slots: DataFrame, keys: Sequence[str], gap_ms: int = GAP_MS) -> DataFrame:
    """Stitch slot summaries into sessions.

    ``slots`` has one row per key and slot with ``_first``, ``_last`` and
    ``_views``.  A slot is no longer than the gap, so its views always share a
    session and only neighbouring slots need comparing.
    """
    along = Window.partitionBy(*keys).orderBy("_slot")
    silence = F.col("_first") - F.lag("_last").over(along)
    session = Window.partitionBy(*keys, "_session")
    return (
        slots.withColumn("_opens", F.coalesce((silence > gap_ms).cast("int"), F.lit(1)))
        .withColumn("_session", F.sum("_opens").over(along))
        .select(
            *keys,
            "_slot",
            F.min("_first").over(session).alias("sessionStart"),
            F.max("_last").over(session).alias("sessionEnd"),
            F.sum("_views").over(session).alias("numPage"),
        )
    )


def _slot_summaries(clicks: DataFrame, keys: Sequence[str]) -> DataFrame:
    return clicks.groupBy(*keys, "_slot").agg(
        F.min("timestamp").alias("_first"),
        F.max("timestamp").alias("_last"),
        F.count("*").alias("_views"),
    )


def _instant(keys: Sequence[str], reloads: DataFrame) -> list[str]:
    """What a view and a mark must agree in, the columns that place them in a slot first."""
    placed = [key for key in (*keys, "_slot") if key in reloads.columns]
    return list(dict.fromkeys((*placed, "masthead", "timestamp")))


def _slot_summaries_without(
    clicks: DataFrame, keys: Sequence[str], reloads: DataFrame
) -> DataFrame:
    """Summaries of the views that stay."""
    moments = clicks.groupBy(*dict.fromkeys((*keys, "_slot", "masthead", "timestamp"))).agg(
        F.count("*").alias("_views")
    )
    return (
        moments.join(reloads, _instant(keys, reloads), "left_anti")
        .groupBy(*keys, "_slot")
        .agg(
            F.min("timestamp").alias("_first"),
            F.max("timestamp").alias("_last"),
            F.sum("_views").alias("_views"),
        )
    )


def _unmarked(clicks: DataFrame, keys: Sequence[str], reloads: DataFrame) -> DataFrame:
    """The clicks at no instant of ``reloads``, in the partitions of their visitor's slots.

    Clicks and marks are merged and pass once in the order of their instants,
    so a mark costs as much as a click however many a slot holds.
    """
    instant = _instant(keys, reloads)
    placed = [key for key in instant if key not in ("masthead", "timestamp") or key in keys]
    marks = reloads.select(*instant, F.lit(True).alias("_marked"))
    merged = clicks.withColumn("_marked", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    gone = F.max("_marked").over(Window.partitionBy(*instant))
    return merged.repartition(*placed).withColumn("_gone", gone).where(~F.col("_gone")).drop("_gone", "_marked")


def sessionise(
    clicks: DataFrame,
    gap_ms: int = GAP_MS,
    scope: Sequence[str] = (),
    by_day: bool = False,
    reloads: DataFrame | None = None,
    slot_ms: int = SLOT_MS,
    tz: str = SYDNEY,
) -> DataFrame:
    """Add session columns to every click.

    A new session starts when a visitor was silent for more than ``gap_ms``.
    Sessions run across all sites in ``clicks`` unless ``scope`` names columns
    (never null) that keep them apart; ``by_day`` also cuts them at local midnight.
    ``reloads`` (see ``reload.reload_flags``) lists views to leave out: giving
    them here rather than removing them first saves a shuffle of whole clicks.

    The clicks are shuffled once, by visitor and slot, and joined to one row per
    such pair.  Without ``reloads`` the join comes straight from a shuffle on both sides, so
    that adaptive execution can split a hot visitor's slot; with them the clicks of a
    slot pass through one task, in front of the join.
    """
    slot_ms = min(slot_ms, gap_ms)
    keys = [*scope, "trackingId"] + (["_day"] if by_day else [])

    def slotted(rows: DataFrame) -> DataFrame:
        at = F.col("timestamp")
        added = {
            "trackingId": F.coalesce("trackingId", F.lit("")),
            "_slot": slot_of(at, slot_ms),
        }
        if by_day:
            added["_day"] = local_date(at, tz)
        return rows.withColumns(added)

    clicks = clicks.transform(slotted)
    if reloads is None:
        slots = _slot_summaries(clicks, keys)
    else:
        reloads = reloads.transform(slotted)
        slots = _slot_summaries_without(clicks, keys, reloads)
        clicks = _unmarked(clicks, keys, reloads)
    joined = clicks.join(session_slots(slots, keys, gap_ms), [*keys, "_slot"])

    session_id = [F.col("sessionStart").cast("string"), F.col("trackingId")]
    if by_day:
        session_id.append(day_key(F.col("timestamp"), tz))
    return joined.withColumns(
        {
            "sessionId": F.concat(*session_id),
            "sessionDuration": F.expr("(sessionEnd - sessionStart) div 1000"),
        }
    ).drop("_slot", "_day")


def session_heads(sessionised: DataFrame) -> DataFrame:
    """The first view of each session (all of them, if several share its instant)."""
    return sessionised.where(F.col("timestamp") == F.col("sessionStart"))
