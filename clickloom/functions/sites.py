"""Site names and the paths visitors take between sites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mobile sites that count as their main brand.
MOBILE_SITES = ("m.smh", "m.theage", "m.drive", "m.traveller")


def brand_of_site(site: Column, mobile_sites: Sequence[str] = MOBILE_SITES) -> Column:
    """Mobile names, in any case, lose their ``m.``; other sites are kept as written."""
    lowered = F.lower(site)
    return F.when(lowered.isin(*mobile_sites), F.substring(lowered, 3, 255)).otherwise(site)


def collapse_repeats(path: Column) -> Column:
    """Drop array elements equal to the one before them."""
    return F.filter(path, lambda x, i: (i == 0) | (x != F.get(path, i - 1)))


def first_steps(path: Column, n: int = 5) -> Column:
    return F.slice(path, 1, n)


def hashed_title(title: Column) -> Column:
    """Titles are reported with ``#`` in place of each space."""
    return F.replace(F.coalesce(title, F.lit("")), F.lit(" "), F.lit("#"))
