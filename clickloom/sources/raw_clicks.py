"""Raw click logs: one JSON object per text line."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.fields import TEXT_FIELDS

# Fixed value: lines that mention the empty visitor id are not wanted.
ZERO_GUID = "00000000-0000-0000-0000-000000000000"

# Fixed values: (escape JSON does not know, what it stands for), in order.
# Any other unknown escape stands for the character itself.
ESCAPE_REPAIRS = (
    ("v", r"\\u0007"),
    ("a", r"\\u0013"),
)
JSON_ESCAPES = r"\"\\/bfnrtu"

UNPARSEABLE = "unparseable"
TRAILING_TEXT = "text after the object"
BAD_EXTRAS = "malformed extras"
NO_TRACKING_ID = "missing trackingId"
BAD_TIMESTAMP = "bad timestamp"

PAIRS = "array<struct<name:string,value:string>>"
RECORD = "map<string,string>"
#: Stands behind a line in the list it is parsed in: a line that is more than one object moves it.
_END = "\\u0000end of line"


def _either(names: Sequence[str]) -> str:
    return names[0] if len(names) == 1 else "{" + ",".join(names) + "}"


def click_paths(root: str, months: Iterable[str], mastheads: Sequence[str]) -> list[str]:
    """The glob of every click file of the given months (``MM-YYYY``) and mastheads.

    One glob for all, so that a masthead without files in a month stops nothing.
    """
    return [f"{root}/{_either(list(months))}-{_either(list(mastheads))}*view*"]


def read_click_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text lines as ``value``, with ``masthead`` and ``device`` from the file name.

    Names look like ``11-2014-smh-m-view-003.gz``; ``-m-`` marks mobile views.  A folder
    of part files with such a name is read like a file.
    """
    file, path = F.col("_metadata.file_name"), F.col("_metadata.file_path")
    name = F.when(file.contains("view"), file).otherwise(F.regexp_extract(path, "([^/]*)/[^/]*$", 1))
    return spark.read.text(paths).select(
        "value",
        F.regexp_extract(name, r"^(?:\d{1,2}-\d{4}-)?([^-.]+)", 1).alias("masthead"),
        F.when(name.contains("-m-view"), "mobile")
        .when(name.contains("-view"), "desktop")
        .alias("device"),
    )


def spread_lines(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """The same lines dealt evenly over ``partitions`` tasks, by default as many as a shuffle has.

    A gzip file cannot be split: one task reads it whole, and without this one
    task would parse it whole as well.  A line goes by its place in the scan, not by its text,
    so that repeated lines part and a task that runs again deals every line as before.
    """
    if partitions is None:
        partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = lines.withColumn("_place", F.monotonically_increasing_id())
    return placed.repartition(partitions, "_place").drop("_place")


def drop_zero_guid(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("value").contains(ZERO_GUID))


def _replace_escape(text: Column, wanted: str, unwanted: str, meaning: str) -> Column:
    r"""Replace ``\`` + ``wanted``, reading escapes in order so that ``\\`` hides what follows it."""
    up_to = rf"\G([^\\]*+(?:\\[{unwanted}][^\\]*+)*+)"
    return F.regexp_replace(text, rf"{up_to}\\([{wanted}])", f"$1{meaning}")


def repair_escapes(text: Column) -> Column:
    """Rewrite escapes that JSON does not allow; lines without any are left alone."""
    repaired = text
    for escape, meaning in ESCAPE_REPAIRS:
        repaired = _replace_escape(repaired, escape, f"^{escape}", meaning)
    repaired = _replace_escape(repaired, f"^{JSON_ESCAPES}", JSON_ESCAPES, "$2")
    return F.when(text.rlike(rf"\\[^{JSON_ESCAPES}]"), repaired).otherwise(text)


def with_flat_fields(
    rows: DataFrame,
    names: Sequence[str],
    record: Column,
    hash_ids: bool = True,
    pairs: Column | None = None,
) -> DataFrame:
    """Add the record's fields ``names`` as columns, and the others as the map ``extras``.

    The record's own fields are overridden by its ``extras`` name/value pairs,
    and of several entries with one name the last counts.  ``trackingId`` is
    hashed unless a pair gives it.  ``pairs``, if given, are those of the record's ``extras``.

    Each step is a column of its own, so that nothing is worked out more than
    once per row, and all but the first run as generated code.
    """
    if pairs is None:
        pairs = F.from_json(record["extras"], PAIRS)
    pairs = F.coalesce(pairs, F.array().cast(PAIRS))
    own, given = F.map_keys(record), F.col("_pairs.name")
    split = rows.withColumn("_pairs", pairs).withColumns(
        {
            "_given": given,
            "_keys": F.reverse(F.concat(own, given)),
            "_values": F.reverse(F.concat(F.map_values(record), F.col("_pairs.value"))),
        }
    )

    def value_of(name: Column) -> Column:
        return F.get("_values", F.array_position("_keys", name).cast("int") - 1)

    columns = {name: value_of(F.lit(name)) for name in names}
    if hash_ids and "trackingId" in columns:
        visitor = columns["trackingId"]
        columns["trackingId"] = F.when(
            F.array_contains("_given", "trackingId"), visitor
        ).otherwise(F.md5(visitor))
    # Pairs without a name are no field.
    taken = F.array(F.lit(None).cast("string"), *[F.lit(name) for name in ("extras", *names)])
    other = F.array_except("_keys", taken)
    return (
        split.withColumn("_other", other)
        .withColumn("extras", F.map_from_arrays("_other", F.transform("_other", value_of)))
        .withColumns(columns)
        .drop("_pairs", "_given", "_keys", "_values", "_other")
    )


def _with_record(lines: DataFrame, text: str) -> DataFrame:
    """Add ``_record``: the one object in the column ``text``, or null if it is no object or not just one.

    Spark's parser stops behind the first object, so the line is parsed as the
    first entry of a list of two, of which the second is known.
    """
    whole = F.concat(F.lit("["), F.col(text), F.lit(f',{{"{_END}":""}}]'))
    entries = F.col("_entries")
    ends = (F.size(entries) == 2) & F.map_contains_key(entries[1], F.lit("\0end of line"))
    return (
        lines.withColumn("_entries", F.from_json(whole, f"array<{RECORD}>"))
        .withColumn("_record", F.when(ends, entries[0]))
        .drop("_entries")
    )


def parse_lines(lines: DataFrame, hash_ids: bool = True) -> DataFrame:
    """Parse ``value`` into click columns, with ``reason`` set on lines that are no click.

    Every other column of ``lines`` is kept.
    """
    extras, listed = F.col("_record")["extras"], F.col("_listed")
    repaired = (
        lines.withColumn("_line", repair_escapes(F.col("value")))
        .transform(_with_record, "_line")
        .withColumn("_listed", F.from_json(extras, PAIRS))
    )
    flat = with_flat_fields(
        repaired, ("timestamp", *TEXT_FIELDS), F.col("_record"), hash_ids, listed
    )
    timestamp = F.col("timestamp").try_cast("bigint")
    # An object in place of the list would be read as a list of one.
    formed = extras.rlike(r"^\s*\[") & listed.isNotNull() & ~F.exists(listed, lambda pair: pair.isNull())
    # Bad lines only are parsed a second time, to tell why.
    why = F.when(F.from_json("_line", RECORD).isNull(), UNPARSEABLE).otherwise(TRAILING_TEXT)
    reason = (
        F.when(F.col("_record").isNull(), why)
        .when(F.col("_record")["trackingId"].isNull(), NO_TRACKING_ID)
        .when(timestamp.isNull(), BAD_TIMESTAMP)
        .when(extras.isNotNull() & ~F.coalesce(formed, F.lit(False)), BAD_EXTRAS)
    )
    click = F.struct(
        timestamp.alias("timestamp"), *TEXT_FIELDS, "extras", reason.alias("reason")
    )
    # A generator keeps later filters on these columns from being pushed below
    # the parsing, which would parse every line once more for each filter.
    return flat.select(*lines.columns, F.inline(F.array(click)))


def parsed_clicks(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).drop("reason", "value")


def quarantined(parsed: DataFrame) -> DataFrame:
    """The lines that are no click, as read, with the reason."""
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason")


def read_clicks(
    spark: SparkSession, paths: str | Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Click files as parsed lines, good and bad; see ``parsed_clicks``, ``quarantined``.

    Lines are parsed in ``partitions`` tasks, see ``spread_lines``; with 0, in those that read them.
    """
    lines = read_click_lines(spark, paths).transform(drop_zero_guid)
    if partitions != 0:
        lines = spread_lines(lines, partitions)
    return parse_lines(lines)
