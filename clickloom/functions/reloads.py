"""How likely a homepage view was an automatic reload, and the draw that decides.

The draws are hashes of the click's own key, so a task that is run again, on
whatever partitioning, decides the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fitted reload curve.
RELOAD_PERIOD_MS = 300_000
RESCALE = 0.996
SPREAD_AFTER_MS = 120_000.0
SPREAD_BEFORE_MS = 140_000.0
KEPT_SHARE = 0.14


def reload_probability(gap_ms: Column) -> Column:
    """A bell around five minutes, wider below than above; no gap, no reload."""
    away = (gap_ms - RELOAD_PERIOD_MS).cast("double")

    def bell(spread: float) -> Column:
        return F.lit(RESCALE) * F.exp(-(away / spread) * (away / spread))

    return (
        F.when(gap_ms > RELOAD_PERIOD_MS, bell(SPREAD_AFTER_MS))
        .when(gap_ms > 0, bell(SPREAD_BEFORE_MS))
        .otherwise(F.lit(0.0))
    )


def uniform_draw(tracking_id: Column, ms: Column, salt: str) -> Column:
    """A repeatable number in [0, 1) for one click."""
    digest = F.md5(F.concat_ws("|", tracking_id, ms.cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def is_reload(probability: Column, tracking_id: Column, ms: Column, salt: str = "") -> Column:
    first = uniform_draw(tracking_id, ms, f"{salt}1")
    second = uniform_draw(tracking_id, ms, f"{salt}2")
    return (probability > 0) & (probability > first) & (second > KEPT_SHARE)
