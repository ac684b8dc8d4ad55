"""The jobs from files to files; see ``python -m clickloom --help``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.referers import RULES
from clickloom.operators.paths import brand_paths
from clickloom.operators.reload import INDEX_CATEGORIES
from clickloom.operators.sessions import session_heads
from clickloom.plans import content, etl, forecast, segments, visitors
from clickloom.sources import ip_ranges, raw_clicks, sessionised
from clickloom.sources.metrics import preview, write_metrics
from clickloom.staging import stage


#: What the forecast reads of a click.
FORECAST_COLUMNS = ("trackingId", "timestamp", "site", "device")


def sessionise_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    output: str,
    week: int,
    year: int | None = None,
    across_sites: bool = True,
    quarantine: str | None = None,
    as_json: bool = False,
    files: int | None = None,
    salt: str = "",
    categories: Mapping[str, str] = INDEX_CATEGORIES,
    rules: Sequence[tuple[str, str]] = RULES,
    partitions: int | None = None,
    show: int = 0,
) -> None:
    """Raw click files to one week of sessionised clicks, of which the first ``show`` are printed.

    Lines are parsed once and staged, as the reload flags, the sessions and the
    clicks themselves each read them: clicks of the week without their text, and
    lines that are no click as text, if wanted.
    """
    parsed = raw_clicks.read_clicks(spark, paths, partitions)
    bad = F.col("reason").isNotNull()
    wanted = etl.is_in_week(week, year)
    parsed = parsed.where(wanted if quarantine is None else bad | wanted)
    parsed = stage(parsed.withColumn("value", F.when(bad, F.col("value"))), "parsed")
    if quarantine is not None:
        lines = raw_clicks.quarantined(parsed).write.mode("overwrite")
        lines.option("compression", "gzip").json(quarantine)
    clicks = raw_clicks.parsed_clicks(parsed)
    done = etl.sessionised_clicks(clicks, categories, across_sites, rules, salt)
    if as_json:
        sessionised.write_json(done, output, files)
    else:
        sessionised.write_parquet(done, output)
    if show:
        read = sessionised.read_json if as_json else sessionised.read_parquet
        preview(read(spark, output, week=week, year=year), show)


def read_sessionised(
    spark: SparkSession,
    path: str,
    as_json: bool = False,
    masthead: str | None = None,
    week: int | None = None,
    year: int | None = None,
) -> DataFrame:
    """Sessionised clicks of a masthead, week and year, or of all, in either format."""
    if as_json:
        # Every report reads the clicks at least once, text would be parsed each time.
        return stage(sessionised.read_json(spark, path, masthead, week, year), "sessionised")
    return sessionised.read_parquet(spark, path, masthead, week, year)


def report_folder(output: str, week: int | None = None, year: int | None = None) -> str:
    """Where the reports of a week stand, beside those of other weeks."""
    parts = [f"{name}={value}" for name, value in (("year", year), ("week", week)) if value is not None]
    return "/".join([output.rstrip("/"), *parts])


def brand_path_report(clicks: DataFrame, output: str) -> None:
    write_metrics(brand_paths(clicks), f"{output}/brand_path")


def content_reports(
    clicks: DataFrame, masthead: str, output: str, session_key: str = "sessionStart"
) -> None:
    reports: dict[str, Callable[..., DataFrame]] = {
        "pageviews": content.section_views,
        "article_pageviews": content.top_articles_by_views,
        "visits": content.section_visits,
        "article_visits": content.top_articles_by_visits,
        "duration": content.section_dwell,
        "article_duration": content.top_articles_by_dwell,
    }
    for name, report in reports.items():
        keyed = report(clicks, masthead, session_key=session_key)
        write_metrics(keyed, f"{output}/{masthead}_{name}")


def visitor_reports(clicks: DataFrame, masthead: str, output: str) -> None:
    write_metrics(
        visitors.visitor_metrics(session_heads(clicks), masthead), f"{output}/{masthead}_visitors"
    )


def segment_reports(clicks: DataFrame, output: str) -> None:
    heads = session_heads(clicks)
    found = segments.visitor_segments(
        segments.visitor_features(heads), segments.cookie_clearers(clicks)
    )
    path = f"{output}/visitor_segments"
    found.write.mode("overwrite").parquet(path)
    found = clicks.sparkSession.read.parquet(path)
    trend = segments.segment_trend(heads, found).withColumn("date", F.col("date").cast("string"))
    write_metrics(trend, f"{output}/repeat_trend", "gzip")


def forecast_report(
    spark: SparkSession,
    paths: str | Sequence[str],
    ip_file: str,
    masthead: str,
    output: str,
    country: str = "AU",
    default_ip: str | None = None,
    ip_col: str = "IpAddress",
    partitions: int | None = None,
) -> None:
    clicks = raw_clicks.parsed_clicks(raw_clicks.read_clicks(spark, paths, partitions))
    clicks = stage(clicks.select(*FORECAST_COLUMNS, ip_col), "forecast")
    rows = forecast.monthly_metrics(
        forecast.device_sessions(clicks, ip_col),
        ip_ranges.read_ranges(spark, ip_file),
        masthead,
        country,
        ip_col,
        default_ip,
    )
    write_metrics(
        rows.withColumn("month_start", F.col("month_start").cast("string")),
        f"{output}/{masthead}_metrics",
        "gzip",
    )
