"""IPv4 addresses as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The form of an address, and the number that stands for "none".
DOTTED = r"^([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})$"
NOT_AN_ADDRESS = 1


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 to a number, each octet cut to 8 bits; anything else gives 1."""
    octets = F.transform(F.split(ip, r"\."), lambda part: part.try_cast("bigint").bitwiseAND(F.lit(255).cast("bigint")))
    total = F.aggregate(octets, F.lit(0).cast("bigint"), lambda n, octet: n * 256 + octet)
    return F.when(is_address(ip), total).otherwise(F.lit(NOT_AN_ADDRESS).cast("bigint"))


def is_address(ip: Column) -> Column:
    return F.coalesce(ip.rlike(DOTTED), F.lit(False))


def ip_block(start_ip: Column, end_ip: Column) -> Column:
    return F.concat_ws(" - ", start_ip, end_ip)
