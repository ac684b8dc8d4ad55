"""Sessionised clicks on disk: flat JSON lines or parquet, by masthead, ISO year and week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.fields import SESSION_NUMBER_FIELDS, SESSION_TEXT_FIELDS, TEXT_FIELDS
from clickloom.functions.timekeys import SYDNEY, iso_year, week_of_year
from clickloom.sources.raw_clicks import with_flat_fields

NUMBERS = ("timestamp", *SESSION_NUMBER_FIELDS)
FOLDERS = ("masthead", "year", "week")
TEXTS = (*TEXT_FIELDS, *SESSION_TEXT_FIELDS, "masthead", "device")


def flat_json(clicks: DataFrame) -> Column:
    """Every field of a click in one flat JSON object of strings, absent fields left out."""
    names = [name for name in (*NUMBERS, *TEXTS) if name in clicks.columns]
    own = F.to_json(F.struct(*[F.col(name).cast("string").alias(name) for name in names]))
    if "extras" not in clicks.columns:
        return own
    extras = F.to_json(
        F.map_filter("extras", lambda key, value: ~key.isin(*names) & value.isNotNull())
    )
    open_end = F.substring(own, F.lit(1), F.length(own) - 1)
    both = F.concat(open_end, F.lit(","), F.substring(extras, F.lit(2), F.length(extras)))
    return F.when(extras != "{}", both).otherwise(own)


def _dated(clicks: DataFrame, tz: str) -> DataFrame:
    """Clicks with the ISO year and week that name their folder.

    Rebalancing gathers a folder's rows into files of the advised size and
    splits what is larger, so neither many tasks nor a large masthead matter.
    """
    at = F.col("timestamp")
    dated = clicks.withColumns({"year": iso_year(at, tz), "week": week_of_year(at, tz)})
    return dated.hint("rebalance", *FOLDERS)


def _selected(
    clicks: DataFrame, masthead: str | None, week: int | None, year: int | None
) -> DataFrame:
    """Rows of the folders asked for."""
    for name, value in (("masthead", masthead), ("week", week), ("year", year)):
        if value is not None:
            clicks = clicks.where(F.col(name) == value)
    return clicks


def write_json(
    clicks: DataFrame, path: str, files: int | None = None, tz: str = SYDNEY
) -> None:
    """Gzip JSON lines, one flat object of strings per click, in one folder per masthead, year and week.

    Folders that get rows are replaced, others stay.  ``files`` fixes the number of tasks that write.
    """
    dated = _dated(clicks, tz) if files is None else _dated(clicks, tz).repartition(files)
    lines = dated.select(flat_json(clicks).alias("value"), *FOLDERS)
    writer = lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*FOLDERS).option("compression", "gzip").text(path)


def read_json(
    spark: SparkSession,
    path: str,
    masthead: str | None = None,
    week: int | None = None,
    year: int | None = None,
    tz: str = SYDNEY,
) -> DataFrame:
    """Clicks written by ``write_json``, or any flat JSON lines with the same names.

    Of a masthead, week and year, or of all.  Where folders name them only those
    are read; where they do not, each click's own fields decide.
    """
    lines = spark.read.text(path)
    if set(FOLDERS) <= set(lines.columns):
        lines = _selected(lines.withColumn("masthead", F.col("masthead").cast("string")), masthead, week, year)
    record = F.from_json("value", "map<string,string>").alias("_record")
    flat = with_flat_fields(lines.select(record), (*NUMBERS, *TEXTS), F.col("_record"), hash_ids=False)
    clicks = flat.select(
        *[F.col(name).try_cast("bigint").alias(name) for name in NUMBERS], *TEXTS, "extras"
    )
    if masthead is not None:
        clicks = clicks.where(F.col("masthead") == masthead)
    if week is not None:
        clicks = clicks.where(week_of_year(F.col("timestamp"), tz) == week)
    if year is not None:
        clicks = clicks.where(iso_year(F.col("timestamp"), tz) == year)
    return clicks


def write_parquet(clicks: DataFrame, path: str, tz: str = SYDNEY) -> None:
    """Parquet in one folder per masthead, ISO year and week; folders that get rows are replaced, others stay."""
    writer = _dated(clicks, tz).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*FOLDERS).parquet(path)


def read_parquet(
    spark: SparkSession,
    path: str,
    masthead: str | None = None,
    week: int | None = None,
    year: int | None = None,
) -> DataFrame:
    """Clicks of one masthead, week and year, or of all; only their folders are read."""
    return _selected(spark.read.parquet(path), masthead, week, year)
