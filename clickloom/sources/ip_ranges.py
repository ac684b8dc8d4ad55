"""IP-to-city files: ``"start","end","country","region","city"`` per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.functions.addresses import ip_block, ip_to_long, is_address

COLUMNS = "start string, end string, country string, region string, city string"


#: Lines that one task puts in order at once.
LINES_TOGETHER = 65_536


def with_line_offsets(
    lines: DataFrame, newline_bytes: int = 1, together: int = LINES_TOGETHER
) -> DataFrame:
    """Add ``offset``: the byte in the (unpacked) file at which each line starts.

    ``lines`` is a plain ``read.text``.  Prefix sums in two steps: the sizes of
    blocks of lines, one row each, are summed in the order of the file, and
    lines within their block; so no task puts a file in order, not even one
    that cannot be split.  Every line must end with ``newline_bytes`` bytes.
    """
    nth = F.monotonically_increasing_id()
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        nth.alias("_nth"),
        (F.octet_length("value") + newline_bytes).cast("bigint").alias("_bytes"),
    ).withColumn("_block", F.expr(f"_nth div {together}"))
    block = ("_file", "_split", "_block")
    earlier = Window.partitionBy("_file").orderBy("_split", "_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = Window.partitionBy(*block).orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    blocks = (
        placed.groupBy(*block)
        .agg(F.sum("_bytes").alias("_size"))
        .select(*block, F.coalesce(F.sum("_size").over(earlier), none).alias("_base"))
    )
    return (
        placed.withColumn("_within", F.coalesce(F.sum("_bytes").over(before), none))
        .join(blocks, list(block))
        .select("value", (F.col("_base") + F.col("_within")).alias("offset"))
    )


def _split_lines(lines: DataFrame) -> tuple[DataFrame, Column]:
    """Lines without a colon (IPv6 is left out) as ``_row``, and whether it is a range in order."""
    row = F.col("_row")
    both = is_address(row["start"]) & is_address(row["end"])
    good = both & (ip_to_long(row["start"]) <= ip_to_long(row["end"]))
    parts = F.from_csv("value", F.lit(COLUMNS))
    return lines.where(~F.col("value").contains(":")).withColumn("_row", parts), good


def quarantined_ranges(lines: DataFrame) -> DataFrame:
    """Lines that are no range: an end is not an address, or the ends are out of order."""
    split, good = _split_lines(lines)
    return split.where(~good).drop("_row")


def parse_ranges(lines: DataFrame) -> DataFrame:
    """``value, offset`` lines to ranges; see ``quarantined_ranges`` for those left out."""
    row = F.col("_row")
    split, good = _split_lines(lines)
    return (
        split.where(good)
        .select(
            ip_to_long(row["start"]).alias("lo"),
            ip_to_long(row["end"]).alias("hi"),
            row["country"].alias("Country"),
            row["region"].alias("Region"),
            row["city"].alias("City"),
            ip_block(row["start"], row["end"]).alias("ipBlock"),
            F.col("offset").alias("ipBlockIndex"),
        )
    )


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    return parse_ranges(with_line_offsets(spark.read.text(path)))
