"""Daily reports on sections and articles, from sessionised clicks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.sites import hashed_title
from clickloom.functions.timekeys import SYDNEY, day_of_month
from clickloom.operators.dwell import dwell_by
from clickloom.operators.ranking import top_per_group
from clickloom.plans.labels import labelled

SECTION = ("day", "assetCategory")
ARTICLE = ("day", "title", "url")


def content_views(
    sessionised: DataFrame,
    keys: Sequence[str],
    session_key: str = "sessionStart",
    tz: str = SYDNEY,
) -> DataFrame:
    """The report columns ``keys`` of every view, missing text as '', and its visit."""
    columns = {
        "day": lambda: day_of_month(F.col("timestamp"), tz),
        "assetCategory": lambda: F.coalesce("assetCategory", F.lit("")),
        "title": lambda: hashed_title(F.col("title")),
        "url": lambda: F.coalesce("url", F.lit("")),
    }
    visit = F.coalesce(F.col(session_key).cast("string"), F.lit(""))
    return sessionised.select(*[columns[key]().alias(key) for key in keys], visit.alias("_visit"))


def _views(sessionised: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    return content_views(sessionised, keys, **options).groupBy(*keys).agg(
        F.count("*").alias("value")
    )


def _visits(sessionised: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    return content_views(sessionised, keys, **options).groupBy(*keys).agg(
        F.count_distinct("_visit").alias("value")
    )


def section_views(sessionised: DataFrame, masthead: str, **options) -> DataFrame:
    return labelled(_views(sessionised, SECTION, **options), "PageViews", masthead, *SECTION, "value")


def section_visits(sessionised: DataFrame, masthead: str, **options) -> DataFrame:
    return labelled(_visits(sessionised, SECTION, **options), "Visits", masthead, *SECTION, "value")


def article_views(sessionised: DataFrame, **options) -> DataFrame:
    return _views(sessionised, ARTICLE, **options)


def article_visits(sessionised: DataFrame, **options) -> DataFrame:
    return _visits(sessionised, ARTICLE, **options)


def top_articles_by_views(sessionised: DataFrame, masthead: str, k: int = 10, **options) -> DataFrame:
    best = top_per_group(article_views(sessionised, **options), ["day"], "value", ["title", "url"], k)
    return labelled(best, "View_article", masthead, *ARTICLE, "value")


def top_articles_by_visits(sessionised: DataFrame, masthead: str, k: int = 10, **options) -> DataFrame:
    best = top_per_group(article_visits(sessionised, **options), ["day"], "value", ["title", "url"], k)
    return labelled(best, "Visit_article", masthead, *ARTICLE, "value")


def section_dwell(sessionised: DataFrame, masthead: str, **options) -> DataFrame:
    totals = dwell_by(sessionised, "assetCategory", **options)
    return labelled(
        totals, "Duration", masthead, *SECTION, F.col("dwellMs").alias("value")
    )


def top_articles_by_dwell(
    sessionised: DataFrame, masthead: str, k: int = 10, urls: int | None = 10, **options
) -> DataFrame:
    """The ``k`` (day, title) pairs read longest, each with its ``urls`` most viewed urls of that day.

    With ``urls`` None every url comes out, one row each: a missing title may have thousands.
    """
    titled = sessionised.withColumn("title", hashed_title(F.col("title")))
    best = (
        dwell_by(titled, "title", **options)
        .orderBy(F.desc("dwellMs"), "day", "title")
        .limit(k)
    )
    pages = content_views(sessionised, ARTICLE, tz=options.get("tz", SYDNEY))
    # ``best`` has at most k rows, each with at least one page of that day.
    joined = pages.join(F.broadcast(best), ["day", "title"])
    # Views are added up by url, so a title of many urls is spread over tasks, each of which passes on few.
    viewed = joined.groupBy(*ARTICLE, "dwellMs").agg(F.count("*").alias("_views"))
    if urls is not None:
        viewed = top_per_group(viewed, ["day", "title"], "_views", ["url"], urls)
    return labelled(viewed, "Duration_Article", masthead, *ARTICLE, F.col("dwellMs").alias("value"))
