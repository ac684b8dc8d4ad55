"""Classify where a page view came from.

Rules are plain data, tried in order; the first that matches names the class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two sites whose own urls count as direct traffic.
OWN_SITE_PATTERNS = (r"www\.smh\.com\.au", r"www\.theage\.com\.au")

# Fixed values: (pattern searched in the referer, class), in order.
# The starred patterns want a literal asterisk, as published.
RULES = (
    (r"www\.google\..*", "GOOGLE"),
    (r"\*\.bing\..*", "BING"),
    (r"\*\.yahoo\..*", "YAHOO"),
    (r"\*\.drive\..*", "DRIVE"),
    (r"www\.smh\.com\.au", "SMH"),
    (r"www\.theage\.com\.au", "THEAGE"),
    (r"traffic\.outbrain\.com", "OUTBRAIN"),
    (r".*reddit\.com", "REDDIT"),
    (r".*twitter\.com", "TWITTER"),
    (r"linkedin\.com", "LINKEDIN"),
    (r".*facebook\.com", "FACEBOOK"),
)
DEFAULT_CLASS = "referral"
DIRECT_CLASS = "DIRECT"

# The same list with the literal asterisks read as "any prefix".
FIXED_RULES = tuple((pattern.replace(r"\*", ".*"), label) for pattern, label in RULES)


def referer_class(
    referer: Column, url: Column, rules: Sequence[tuple[str, str]] = RULES
) -> Column:
    referer = F.coalesce(referer, F.lit(""))
    url = F.coalesce(url, F.lit(""))
    own_url = url.rlike("|".join(OWN_SITE_PATTERNS))
    result = F.when((referer == "direct") | ((referer == "") & own_url), DIRECT_CLASS)
    for pattern, label in rules:
        result = result.when(referer.rlike(pattern), label)
    return result.otherwise(DEFAULT_CLASS)
