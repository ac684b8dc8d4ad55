"""The registered queries: one or more per operator, over whole tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.referers import FIXED_RULES, RULES, referer_class
from clickloom.functions.timekeys import day_key, day_of_month, local_time, month_key, week_of_year
from clickloom.operators.geo import add_location
from clickloom.operators.paths import brand_paths
from clickloom.operators.reload import (
    index_gaps,
    index_views,
    reload_flags,
    remove_reloads,
    with_reload_probability,
)
from clickloom.operators.sessions import session_heads, sessionise
from clickloom.plans import content, etl, forecast, segments, visitors
from clickloom.sources import ip_ranges, raw_clicks, sessionised
from clickloom.sources.metrics import read_metrics, write_metrics
from clickloom.staging import CHECKPOINT_DIR, new_path, stage
from harness import adapter

Query = Callable[[SparkSession, str], DataFrame]
MASTHEAD = "all"
SESSION_COLUMNS = (
    "trackingId", "timestamp", "site",
    "sessionId", "sessionStart", "sessionEnd", "sessionDuration", "numPage",
)


def _clicks(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(adapter.clicks(spark, sf_dir))


def _sessions(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(sessionise(adapter.clicks(spark, sf_dir)))


def _heads(query: Callable[[DataFrame], DataFrame]) -> Query:
    return _sessions(lambda rows: query(session_heads(rows)))


def _metric(*names: str) -> Query:
    return _heads(lambda heads: visitors.visitor_metrics(heads, MASTHEAD, names))


def _time_keys(clicks: DataFrame) -> DataFrame:
    at = F.col("timestamp")
    return clicks.select(
        "trackingId",
        "timestamp",
        F.date_format(local_time(at), "yyyy-MM-dd HH:mm:ss").alias("local_time"),
        week_of_year(at).alias("week"),
        day_of_month(at).alias("day"),
        day_key(at).alias("day_key"),
        month_key(at).alias("month_key"),
    )


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw_clicks.drop_zero_guid(adapter.raw_lines(spark, sf_dir))
    return raw_clicks.parse_lines(lines)


def _parse_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _click_columns(raw_clicks.parsed_clicks(_parsed(spark, sf_dir)))


def _click_columns(clicks: DataFrame) -> DataFrame:
    return clicks.select(
        "trackingId", "timestamp", "masthead", "device", "site", "assetType", "assetCategory",
        "title", "url", "referer", "IpAddress", "memberId", "userAgent",
        F.col("extras")["slot"].alias("slot"),
        F.size("extras").alias("other_fields"),
    )


def _gaps(clicks: DataFrame) -> DataFrame:
    return index_gaps(index_views(clicks))


def _probabilities(clicks: DataFrame) -> DataFrame:
    return with_reload_probability(_gaps(clicks)).withColumn(
        "probability", F.round("probability", 9)
    )


def _after_reload(clicks: DataFrame) -> DataFrame:
    return remove_reloads(clicks, reload_flags(clicks)).select(
        "trackingId", "timestamp", "masthead", "site", "assetCategory"
    )


def _all_mastheads(clicks: DataFrame) -> DataFrame:
    return etl.sessionised_clicks(clicks).select(*SESSION_COLUMNS, "masthead", "finalReferer")


def _each_masthead(clicks: DataFrame) -> DataFrame:
    return etl.sessionised_clicks(clicks, across_sites=False).select(
        *SESSION_COLUMNS, "masthead", "finalReferer"
    )


def _combined(clicks: DataFrame) -> DataFrame:
    """The three masthead groups cleaned one by one, then put together."""
    groups = []
    for masthead in ("smh", "theage"):
        group = clicks.where(F.col("masthead") == masthead)
        groups.append(remove_reloads(group, reload_flags(group)))
    groups.append(clicks.where(~F.col("masthead").isin("smh", "theage")))
    return etl.combine(*groups).groupBy("masthead", "device").agg(
        F.count("*").alias("clicks"), F.sum("timestamp").alias("checksum")
    )


def _referer_class(rules) -> Query:
    return _clicks(
        lambda rows: rows.select(
            "trackingId", "timestamp", "referer", "url",
            referer_class(F.col("referer"), F.col("url"), rules).alias("finalReferer"),
        )
    )


def _ip_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = add_location(adapter.clicks(spark, sf_dir), adapter.nation_ranges(spark, sf_dir))
    return located.select(
        "trackingId", "timestamp", "IpAddress", "Country", "Region", "City", "ipBlock", "ipBlockIndex"
    )


def _ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ip_ranges.parse_ranges(adapter.customer_range_lines(spark, sf_dir))


def _ip_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hundreds of short ranges to a bucket, at any place, with gaps."""
    return add_location(adapter.events_in_ranges(spark, sf_dir), adapter.unaligned_ranges(spark, sf_dir))


def _ip_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges out of real files, one in many splits and one that cannot be split."""
    _name_shared_folder(spark)
    lines = adapter.customer_range_lines(spark, sf_dir)
    in_order = lines.repartition(1).sortWithinPartitions("offset", F.col("value").contains(":")).select("value")
    found = []
    most = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(most)
    for name, packed in (("packed", "gzip"), ("plain", "none")):
        path = new_path(spark, "ranges")
        in_order.write.option("compression", packed).text(path)
        spark.conf.set(most, "65536")  # planned, and run, with small splits
        try:
            ranges = stage(ip_ranges.read_ranges(spark, path), "ranges")
        finally:
            spark.conf.set(most, before)
        found.append(ranges.select(F.lit(name).alias("file"), "ipBlock", "ipBlockIndex"))
    return found[0].unionByName(found[1])


def _click_files(spark: SparkSession, sf_dir: str) -> str:
    """The folder of packed files of raw lines, named by month, masthead and device."""
    _name_shared_folder(spark)
    root = new_path(spark, "click-files")
    adapter.write_click_files(spark, sf_dir, root)
    return root


def _parse_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a few packed files, parsed in as many tasks as a shuffle has."""
    paths = raw_clicks.click_paths(_click_files(spark, sf_dir), ["*"], ["smh", "theage", "drive", "traveller"])
    return _click_columns(raw_clicks.parsed_clicks(raw_clicks.read_clicks(spark, paths)))


def _some_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One masthead left out, another and a month without any file."""
    mastheads = ["smh", "theage", "drive", "brisbanetimes"]
    paths = raw_clicks.click_paths(_click_files(spark, sf_dir), ["01-2024", "02-2024"], mastheads)
    clicks = raw_clicks.parsed_clicks(raw_clicks.read_clicks(spark, paths))
    return clicks.select("masthead", "device", "trackingId", "timestamp", "title")


def _through_files(rows: DataFrame) -> DataFrame:
    """A report written in files of a few rows, and read back."""
    spark = rows.sparkSession
    _name_shared_folder(spark)
    path = new_path(spark, "metrics")
    write_metrics(rows, path, rows_a_file=25)
    return read_metrics(spark, path, rows.schema)


def _monthly(metric: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _name_shared_folder(spark)
        rows = forecast.monthly_metrics(
            forecast.device_sessions(adapter.clicks(spark, sf_dir)),
            adapter.nation_ranges(spark, sf_dir),
            MASTHEAD,
        ).where(F.col("metric") == metric)
        return rows.withColumn("month_start", F.col("month_start").cast("string"))

    return query


def _name_shared_folder(spark: SparkSession) -> None:
    """In the sandbox no cluster names a shared folder; one machine may use its own."""
    if not (spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clickloom-"))


def _json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _name_shared_folder(spark)
    path = new_path(spark, "sessionised-json")
    sessionised.write_json(etl.sessionised_clicks(adapter.clicks(spark, sf_dir)), path)
    return sessionised.read_json(spark, path).select(
        *SESSION_COLUMNS, "masthead", "device", "title", "finalReferer"
    )


def _json_by_masthead_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One masthead and week out of a JSON folder that holds them all."""
    _name_shared_folder(spark)
    path = new_path(spark, "sessionised-json")
    sessionised.write_json(etl.sessionised_clicks(adapter.clicks(spark, sf_dir)), path)
    return sessionised.read_json(spark, path, "smh", 2, 2024).select(*SESSION_COLUMNS, "masthead")


def _repeated_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks 1 and 2 written in turn, week 2 once more: each stands there once."""
    _name_shared_folder(spark)
    path = new_path(spark, "sessionised-weeks")
    done = stage(etl.sessionised_clicks(adapter.clicks(spark, sf_dir)), "sessionised")
    for week in (1, 2, 2):
        sessionised.write_parquet(etl.in_week(done, week), path)
    return sessionised.read_parquet(spark, path).select(*SESSION_COLUMNS, "masthead", "year", "week")


def _parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _name_shared_folder(spark)
    path = new_path(spark, "sessionised-parquet")
    sessionised.write_parquet(etl.sessionised_clicks(adapter.clicks(spark, sf_dir)), path)
    return sessionised.read_parquet(spark, path, masthead="smh", week=2).select(
        *SESSION_COLUMNS, "masthead", "week"
    )


def _raw_to_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: damaged lines, week, reloads, sessions, weekly and daily metrics."""
    _name_shared_folder(spark)
    parsed = stage(_parsed(spark, sf_dir), "parsed")
    weekly = etl.in_week(raw_clicks.parsed_clicks(parsed), week=2)
    return visitors.visitor_metrics(session_heads(etl.sessionised_clicks(weekly)), MASTHEAD)


def _with_segments(
    query: Callable[[DataFrame, DataFrame], DataFrame], source: Query = adapter.clicks
) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        clicks = source(spark, sf_dir)
        heads = session_heads(sessionise(clicks))
        found = segments.visitor_segments(
            segments.visitor_features(heads), segments.cookie_clearers(clicks)
        )
        return query(heads, found)

    return run


def _segments(heads: DataFrame, found: DataFrame) -> DataFrame:
    return found.withColumn("cookieClearer", F.col("cookieClearer").cast("int"))


def _trend(heads: DataFrame, found: DataFrame) -> DataFrame:
    return segments.segment_trend(heads, found).withColumn("date", F.col("date").cast("string"))


QUERIES: dict[str, Query] = {
    "time_keys": _clicks(_time_keys),
    "week_filter": _clicks(
        lambda rows: etl.in_week(rows, 2).select("trackingId", "timestamp", "site")
    ),
    "sessionise": _sessions(lambda rows: rows.select(*SESSION_COLUMNS)),
    "session_heads": _heads(lambda rows: rows.select(*SESSION_COLUMNS)),
    "sessionise_daily": _clicks(
        lambda rows: sessionise(rows, by_day=True).select(*SESSION_COLUMNS)
    ),
    "visitors": _metric("visitors"),
    "visits": _metric("visits"),
    "numpage": _metric("numpage"),
    "session_duration": _metric("session"),
    "bounce": _metric("bounce"),
    "repeat_visitors": _metric("repeat"),
    "visitor_metrics_all": _metric(*visitors.LABELS),
    "pageviews_by_category": _sessions(lambda rows: content.section_views(rows, MASTHEAD)),
    "visits_by_category": _sessions(lambda rows: content.section_visits(rows, MASTHEAD)),
    "visits_by_category_exact": _sessions(
        lambda rows: content.section_visits(rows, MASTHEAD, session_key="sessionId")
    ),
    "visits_by_article_exact": _sessions(
        lambda rows: content.article_visits(rows, session_key="sessionId")
    ),
    "dwell_by_category_exact": _sessions(
        lambda rows: content.section_dwell(rows, MASTHEAD, session_key="sessionId")
    ),
    "pageviews_by_article": _sessions(content.article_views),
    "visits_by_article": _sessions(content.article_visits),
    "top10_articles_by_views": _sessions(
        lambda rows: content.top_articles_by_views(rows, MASTHEAD)
    ),
    "top10_articles_by_visits": _sessions(
        lambda rows: content.top_articles_by_visits(rows, MASTHEAD)
    ),
    "dwell_by_category": _sessions(lambda rows: content.section_dwell(rows, MASTHEAD)),
    "top10_dwell_articles": _sessions(lambda rows: content.top_articles_by_dwell(rows, MASTHEAD)),
    "brand_path": _sessions(
        lambda rows: brand_paths(rows).withColumn("path", F.array_join("path", ">"))
    ),
    "parse_raw": _parse_raw,
    "quarantine": lambda spark, sf_dir: raw_clicks.quarantined(_parsed(spark, sf_dir)),
    "index_views": _clicks(
        lambda rows: index_views(rows).select("trackingId", "timestamp", "masthead", "assetCategory")
    ),
    "index_gaps": _clicks(_gaps),
    "reload_probability": _clicks(_probabilities),
    "reload_flags": _clicks(reload_flags),
    "clicks_after_reload": _clicks(_after_reload),
    "combined_mastheads": _clicks(_combined),
    "sessionise_all_mastheads": _clicks(_all_mastheads),
    "sessionise_each_masthead": _clicks(_each_masthead),
    "referer_class": _referer_class(RULES),
    "referer_class_fixed": _referer_class(FIXED_RULES),
    "ip_ranges": _ip_ranges,
    "ip_enrich": _ip_enrich,
    "monthly_visits": _monthly("Month_visit"),
    "monthly_pageviews": _monthly("Month_pageviews"),
    "sessionised_roundtrip": _json_roundtrip,
    "sessionised_parquet": _parquet_roundtrip,
    "json_by_masthead_week": _json_by_masthead_week,
    "repeated_weeks": _repeated_weeks,
    "raw_to_visitor_metrics": _raw_to_metrics,
    "visitor_features": _heads(segments.visitor_features),
    "cookie_clearers": _clicks(segments.cookie_clearers),
    "visitor_segments": _with_segments(_segments),
    "segments_of_every_kind": _with_segments(_segments, adapter.visitors_of_every_kind),
    "trend_of_every_kind": _with_segments(_trend, adapter.visitors_of_every_kind),
    "flagged_heads": _with_segments(
        lambda heads, found: segments.flag_heads(heads, found).select(
            "trackingId", "timestamp", "sessionId", "repeatFlag"
        )
    ),
    "segment_trend": _with_segments(_trend),
    "parse_spread": _parse_spread,
    "click_files": _some_files,
    "ip_lookup_unaligned": _ip_lookup,
    "ip_file_offsets": _ip_offsets,
    "metrics_roundtrip": _heads(
        lambda heads: _through_files(visitors.visitor_metrics(heads, MASTHEAD, list(visitors.LABELS)))
    ),
    "paths_roundtrip": _sessions(
        lambda rows: _through_files(brand_paths(rows)).withColumn("path", F.array_join("path", ">"))
    ),
}
