"""Column names shared by every module.

A click is one page view.  The fields below get a column of their own; any
other field of the raw record stays in the open ``extras`` map.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the raw click records.
TEXT_FIELDS = (
    "trackingId",
    "site",
    "assetType",
    "assetCategory",
    "title",
    "url",
    "referer",
    "IpAddress",
    "memberId",
    "userAgent",
)

# Field names added by sessionising and by the referer rules.
SESSION_TEXT_FIELDS = ("sessionId", "finalReferer")
SESSION_NUMBER_FIELDS = ("sessionStart", "sessionEnd", "sessionDuration", "numPage")

EXTRAS_TYPE = T.MapType(T.StringType(), T.StringType())
