"""Pieces that several operators share: words, tables, shared storage, held-out folds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space, and the control characters from tab to carriage return.
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``, unchanged; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names.

    Only where that is unset under a local master, as in tests, a folder of our own is set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clickloom-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, lost executors cost nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Key tables of up to this size are broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 32 << 20


def small(keys: DataFrame) -> DataFrame:
    """A written key table of numbers and arrays of them, marked for broadcast if its values are few bytes."""
    lists = [F.coalesce(F.size(c), F.lit(0)) for c, kind in keys.dtypes if kind.startswith("array")]
    row = sum((16 * size for size in lists), F.lit(16 + 8 * len(keys.columns)).cast("bigint"))
    return F.broadcast(keys) if (keys.agg(F.sum(row)).first()[0] or 0) <= BROADCAST_BYTES else keys
