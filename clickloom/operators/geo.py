"""Locate visitors by the address block their IP falls into."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.addresses import ip_to_long, is_address

BUCKET = 65_536
#: Addresses that one task orders at once; a bucket holds so many blocks that their last ranges are few rows.
BLOCK = 256
LOCATION = ("Country", "Region", "City", "ipBlock", "ipBlockIndex")


def _last_ranges(addresses: DataFrame, ranges: DataFrame) -> DataFrame:
    """(address, _found): the last range that starts at or before each of the distinct ``addresses``.

    Addresses and range starts are ordered block by block.  A block hands its
    last range on, and of a bucket's blocks only these are put in order; ranges
    that go on into the next bucket start there anew, so nothing passes between buckets.
    """
    place = {"_bucket": F.expr(f"address div {BUCKET}"), "_block": F.expr(f"address div {BLOCK}")}
    buckets = F.sequence(F.expr(f"lo div {BUCKET}"), F.expr(f"hi div {BUCKET}"))
    starts = (
        ranges.select(F.explode(buckets).alias("_in"), F.struct("lo", "hi", *LOCATION).alias("_range"))
        .select(
            F.greatest(F.col("_range.lo"), F.col("_in") * BUCKET).alias("address"),
            F.lit(0).alias("_asks"),
            "_range",
        )
        .withColumns(place)
    )
    asks = addresses.withColumn("_asks", F.lit(1)).withColumns(place)
    so_far = (
        Window.partitionBy("_bucket", "_block")
        .orderBy("address", "_asks", "_range.hi")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = (
        asks.unionByName(starts, allowMissingColumns=True)
        .withColumn("_inside", F.last("_range", ignorenulls=True).over(so_far))
        .where(F.col("_asks") == 1)
    )
    ends = starts.groupBy("_bucket", "_block").agg(
        F.max_by("_range", F.struct("address", "_range.hi")).alias("_last")
    )
    asked = asks.select("_bucket", "_block").distinct().withColumn("_asked", F.lit(True))
    earlier = (
        Window.partitionBy("_bucket").orderBy("_block").rangeBetween(Window.unboundedPreceding, -1)
    )
    handed = (
        ends.unionByName(asked, allowMissingColumns=True)
        .withColumn("_handed", F.last("_last", ignorenulls=True).over(earlier))
        .where(F.col("_asked"))
        .select("_bucket", "_block", "_handed")
    )
    return inside.join(handed, ["_bucket", "_block"]).select(
        "address", F.coalesce("_inside", "_handed").alias("_found")
    )


def locate_addresses(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Add location columns to rows with an ``address`` number, by disjoint ``lo``..``hi`` ranges.

    Each distinct address is looked up once, in one pass over at most 256
    addresses and the ranges that start among them, whatever the number of rows.  The
    result is joined back on the address, a join whose rows adaptive execution
    can split.  Null addresses, and those between the ranges, have no location.
    """
    asked = rows.select("address").where(F.col("address").isNotNull()).distinct()
    hit = F.col("address") <= F.col("_found.hi")
    located = _last_ranges(asked, ranges).where(hit).select("address", *(F.col(f"_found.{name}").alias(name) for name in LOCATION))
    return rows.join(located, "address", "left").select(*rows.columns, *LOCATION)


def with_address(
    clicks: DataFrame, ip_col: str = "IpAddress", default_ip: str | None = None
) -> DataFrame:
    """Add ``address``, the number of the click's IP or else of ``default_ip``; null if that is no address."""
    ip = F.coalesce(ip_col, F.lit(default_ip or ""))
    return clicks.withColumn("address", F.when(is_address(ip), ip_to_long(ip)))


def add_location(
    clicks: DataFrame,
    ranges: DataFrame,
    ip_col: str = "IpAddress",
    default_ip: str | None = None,
) -> DataFrame:
    """Add location columns to every click; null where no range holds the address."""
    return locate_addresses(with_address(clicks, ip_col, default_ip), ranges).drop("address")


def in_country(clicks: DataFrame, country: str = "AU") -> DataFrame:
    return clicks.where(F.col("Country") == country)
