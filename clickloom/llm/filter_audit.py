"""Interaction audit of document filters: what each removes in every order they can be applied in.

A document's failures are one number, a bit for each filter.  All that the audit asks
for any order follows from how many documents have each combination of bits.

The last filter is an existential self-join: a document fails if one of smaller doc_id has the
same text.  Only texts whose hash occurs twice take part.  The right side of the semi
join is one row per text, the smallest id that has it; a text that holds more
than a ``1 / HOT`` of all rows is dealt over salts, of which there can be few.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import words, written

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
SYMBOLS = "#$%&*|"
FILTERS = "ABCDE"
_COPY = 1 << FILTERS.index("E")
#: A text with more than this share of all rows is dealt over salts; fewer than ``HOT`` texts can have it.
HOT = 256


def failures(text: Column) -> Column:
    """Bits of the filters that look at the text alone."""
    found = words(text)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    tests = (
        F.size(found) < MIN_WORDS,
        100 * F.size(F.array_distinct(found)) < MIN_DISTINCT_PERCENT * F.size(found),
        100 * capitals > MAX_CAPITAL_PERCENT * F.length(text),
        F.length(text) != F.length(F.translate(text, SYMBOLS, "")),
    )
    return sum((F.when(test, 1 << k).otherwise(0) for k, test in enumerate(tests)), F.lit(0))


def _documents(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text")
    ).withColumn("hash", F.xxhash64("text"))


def copies(docs: DataFrame, hashed: DataFrame) -> DataFrame:
    """(doc_id, part, hash) of the rows of ``docs`` whose text a smaller doc_id has; ``hashed`` has all hashes, written."""
    seen = written(hashed.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "seen")
    rows = hashed.count()
    per_salt = max(1, rows // HOT)
    # fewer than HOT rows: so many texts can have more than their share
    hot = F.broadcast(seen.where(F.col("n") > per_salt).select("hash", F.ceil(F.col("n") / per_salt).alias("salts")))
    rare = seen.where(F.col("n") <= per_salt).select("hash")
    dealt = docs.join(hot, "hash", "left")
    own = F.pmod(F.xxhash64("doc_id"), F.col("salts"))
    suspects = written(
        dealt.where("salts is not null")
        .withColumn("salt", own)
        .union(
            dealt.where("salts is null").withColumn("salt", F.lit(0).cast("bigint")).join(rare, "hash", "left_semi")
        )
        .where("doc_id is not null"),
        "suspects",
    )
    originals = (
        suspects.groupBy("hash", "text")
        .agg(F.min("doc_id").alias("first"), F.max("salts").alias("salts"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1)) - 1)))
    )
    left, right = suspects.alias("left"), originals.alias("right")
    same = (
        (F.col("left.hash") == F.col("right.hash"))
        & (F.col("left.salt") == F.col("right.salt"))
        & (F.col("left.text") == F.col("right.text"))
        & (F.col("right.first") < F.col("left.doc_id"))
    )
    return left.join(right, same, "left_semi").select("doc_id", "part", "hash").distinct()


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, good, toxic, n): how many rows of each part fail just the filters in ``bits``.

    A part is a value of lang, the empty string for null.
    """
    texts = _documents(docs)
    own = written(texts.select("doc_id", "part", "hash", failures(F.col("text")).alias("bits")), "failures")
    copied = copies(texts, own.select("hash"))
    marks = own.select("doc_id", "part", "hash", "bits", F.lit(1).alias("n"), F.lit(0).alias("copy")).unionByName(
        copied.select("*", F.lit(0).alias("bits"), F.lit(0).alias("n"), F.lit(_COPY).alias("copy"))
    )
    failed = marks.groupBy("doc_id", "part", "hash").agg(
        (F.max("bits") + F.max("copy")).alias("bits"), F.sum("n").alias("n")
    )
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_labelled")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    return (
        failed.join(known, failed["doc_id"] == known["_labelled"], "left")
        .groupBy("part", "bits", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
        .agg(F.sum("n").alias("n"))
    )


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bits of the filters before, bit of the step's filter) of every order."""
    orders = map("".join, permutations(FILTERS))
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    return [(o, k + 1, sum(bit[f] for f in o[:k]), bit[o[k]]) for o in orders for k in range(len(o))]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every step of every order in which the filters can be applied, for every part.

    (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley), zeros
    included.  Every row of ``docs`` counts as a document, repeated rows too; rows of one doc_id are
    no copies of each other, and a row without an id neither is a copy nor makes one.  A null text
    counts as empty.  A doc_id labelled more than once is good, or toxic, if one label says so;
    null labels say nothing.  Other columns play no part; no documents, no rows.
    """
    steps = _steps()
    spark = docs.sparkSession
    cells = sorted({(before, bit) for _, _, before, bit in steps})
    cell = F.explode(F.array(*(F.struct(F.lit(a).alias("before"), F.lit(b).alias("filter")) for a, b in cells)))
    each = combinations(docs, labels).withColumn("cell", cell).select("*", "cell.*")
    fails = F.col("bits").bitwiseAND(F.col("filter")) != 0
    reached = F.col("bits").bitwiseAND(F.col("before")) == 0

    def count(test: Column) -> Column:
        return F.sum(F.when(test, F.col("n")).otherwise(0)).cast("bigint")

    counted = each.groupBy("part", "before", "filter").agg(
        count(reached & ~fails).alias("kept"),
        count(reached & fails).alias("removed"),
        count(~reached & fails).alias("redundant"),
        count(F.col("bits") == F.col("filter")).alias("unique_fails"),
        count(reached & fails & (F.col("good") == 1)).alias("good_lost"),
        count(reached & fails & (F.col("toxic") == 1)).alias("toxic_lost"),
    )
    orders = spark.createDataFrame(steps, "filter_order string, step int, before int, filter int")
    times = orders.groupBy("before", "filter").agg(F.count("*").alias("orders"))
    totals = (
        counted.join(F.broadcast(times), ["before", "filter"])
        .groupBy("part", "filter")
        .agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    )
    return (
        counted.join(F.broadcast(orders), ["before", "filter"])  # five steps of each order
        .join(totals, ["part", "filter"])
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
            "shapley",
        )
    )
