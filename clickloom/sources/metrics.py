"""Metric rows on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

STEP = ">"
#: Rows to a file: any report of totals fits one, and a report of articles is cut.
ROWS_A_FILE = 1_000_000


def write_metrics(
    rows: DataFrame, path: str, compression: str | None = None, rows_a_file: int = ROWS_A_FILE
) -> None:
    """CSV with a header, in place of what ``path`` held, cut after ``rows_a_file`` rows.

    Rows are written by the tasks that have them: adaptive execution makes one
    task of a small report, and no task has to take a large one in.  Arrays are
    written joined by ``>``, and missing text differs from empty text.
    """
    flat = rows.select(
        *[
            F.array_join(name, STEP).alias(name) if kind.startswith("array") else F.col(name)
            for name, kind in rows.dtypes
        ]
    )
    writer = flat.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_a_file)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def read_metrics(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Metric files as they were written: ``schema`` is that of the rows, arrays included.

    An array of no steps comes back as one of an empty step, as both are written alike.
    """
    lists = {f.name for f in schema.fields if isinstance(f.dataType, ArrayType)}
    flat = ", ".join(
        f"`{f.name}` {'string' if f.name in lists else f.dataType.simpleString()}" for f in schema.fields
    )
    # What is missing is written as nothing, what is empty as two quotes; by default both are read as missing.
    rows = spark.read.option("header", True).option("nullValue", "\0").schema(flat).csv(path)
    return rows.withColumns({name: F.split(name, STEP) for name in rows.columns if name in lists})


def preview(rows: DataFrame, n: int = 50) -> None:
    """Print the first ``n`` rows."""
    rows.show(n, truncate=False)
