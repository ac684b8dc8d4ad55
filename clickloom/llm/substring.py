"""Removal of repeated passages: windows of 20 words that also start earlier in the corpus.

Difference-cover anchors: of the positions modulo 13 only 0, 1, 3 and 9 are
hashed.  Every distance modulo 13 is a difference of two of these, so whenever
20 words occur at two places, some position within the first 13 of them is
covered at both, and the 8 words from there (an anchor) are hashed at both.

1. Documents whose words are wholly those of an earlier one are settled by their digests.
2. Anchors of the others are shuffled by hash; those found once are dropped.
3. Only windows that hold a repeated anchor are extended to their 20 words, hashed
   with 128 bits, and shuffled by that hash in (doc_id, start) order; all but the
   first of each hash are repeats.
4. Words under repeats are cut out of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import let, small, words, written
from clickloom.llm.hashing import Windows, flat, later, portions, positions, repeats, same_keys, spread

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
_STRETCHES = "doc_id long, stretches array<struct<a:int,b:int>>"
_CUT_STRETCHES = "doc_id long, key long, stretches array<struct<a:int,b:int>>"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    covered = np.isin(np.arange(PERIOD), COVER)
    for batch in portions(batches, "hashes"):
        values, begins, sizes = flat(batch.column("hashes"))
        room = np.maximum(sizes - WINDOW + PERIOD, 0) * (sizes >= WINDOW)  # anchor starts
        row, at = positions(room)
        keep = covered[at % PERIOD]
        row, at = row[keep], at[keep]
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[row]
        anchor = Windows(values).at(begins[row] + at, ANCHOR).view(np.int64)
        # of anchors that repeat within the batch only the first stays with its hash
        settled, behind = same_keys([anchor], ids, at)
        anchor = np.where(behind, spread(ids, at), anchor)
        columns = (anchor, ids, at.astype(np.int32), settled)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "doc_id", "at", "settled"])


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in repeats(batches, ["anchor"]):
        yield batch.select(["doc_id", "at"])


def _stretches(batch: pa.RecordBatch, column: str, before: int, after: int) -> pa.RecordBatch:
    """Positions p of a document to the merged stretches of all [p - before, p + after)."""
    values, begins, sizes = flat(batch.column(column))
    counts, lows, highs = [], [], []
    for begin, size in zip(begins, sizes):
        at = np.unique(values[begin : begin + size]).astype(np.int64)
        new = np.flatnonzero(np.diff(at) > before + after) + 1
        lows.append(np.maximum(at[np.concatenate([[0], new])] - before, 0))
        highs.append(at[np.concatenate([new - 1, [len(at) - 1]])] + after)
        counts.append(len(new) + 1)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (lows, highs))
    pairs = pa.StructArray.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32())], ["a", "b"])
    of = [c for c in ("doc_id", "key") if c in batch.schema.names]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in of), pa.ListArray.from_arrays(pa.array(offsets), pairs)], [*of, "stretches"]
    )


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated anchors to the starts of the windows that hold them."""
    for batch in batches:
        yield _stretches(batch, "marks", PERIOD - 1, 1)


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Starts of repeated windows to the words they cover."""
    for batch in batches:
        yield _stretches(batch, "starts", 0, WINDOW)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows that start in a document's stretches."""
    for batch in portions(batches, "hashes"):
        values, begins, sizes = flat(batch.column("hashes"))
        lists = batch.column("stretches")
        offsets = lists.offsets.to_numpy()
        inner = lists.values
        low = inner.field("a").to_numpy().astype(np.int64)[offsets[0] : offsets[-1]]
        high = inner.field("b").to_numpy().astype(np.int64)[offsets[0] : offsets[-1]]
        row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        high = np.minimum(high, sizes[row] - WINDOW + 1)
        which, nth = positions(np.maximum(high - low, 0))
        owner, at = row[which], low[which] + nth
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[owner]
        where = begins[owner] + at
        h1, h2 = (Windows(values, k).at(where, WINDOW).view(np.int64) for k in (0, 1))
        # what starts earlier within the batch is settled and need not meet its equals
        _, settled = same_keys([h2, h1], ids, at)
        h1 = np.where(settled, spread(ids, at), h1)
        key = batch.column("key").to_numpy(zero_copy_only=False)[owner]
        columns = (h1, h2, ids, at.astype(np.int32), key, settled)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h1", "h2", "doc_id", "at", "key", "settled"])


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in later(batches, ["h1", "h2"], ["doc_id", "at"]):
        yield batch.select(["doc_id", "key", "at"])


def _digest(found: Column) -> Column:
    return F.xxhash64(found)


def repeated_stretches(docs: DataFrame) -> DataFrame:
    """(doc_id, key, stretches): the stretches [a, b) of word positions to remove, only for texts that have some.

    ``doc_id`` names a document: rows that repeat one are taken as that document
    again, not as an earlier one.  ``key`` is 0 unless rows of the id have different words; then
    it is ``_digest`` of the words, and the row is for these words only.  Rows with a null id or text take no part.
    """
    split = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), words(F.col("text")).alias("words")
    )
    digests = written(
        split.select(
            "doc_id",
            F.size("words").alias("n"),
            _digest(F.col("words")).alias("d1"),
            F.xxhash64(F.lit(1), "words").alias("d2"),
        ),
        "digests",
    )
    several = written(
        digests.groupBy("doc_id").agg(F.min("d1").alias("low"), F.max("d1").alias("high")).where("low != high").select("doc_id"),
        "several",
    )
    named = small(several).withColumn("_several", F.lit(True))

    def keyed(rows: DataFrame, digest: Column) -> DataFrame:
        key = F.when(F.col("_several"), digest).otherwise(F.lit(0).cast("bigint"))
        return rows.join(named, "doc_id", "left").withColumn("key", key).drop("_several")

    found = keyed(split.where(F.size("words") >= WINDOW), _digest(F.col("words")))
    # a document with the words of an earlier one goes whole, and no other needs to look at it
    digests = keyed(digests.where(F.col("n") >= WINDOW), F.col("d1"))
    first = written(
        digests.groupBy("n", "d1", "d2")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1"),
        "copied",
    )
    copies = written(
        digests.join(small(first), ["n", "d1", "d2"]).where("doc_id != first").select("doc_id", "key", "n").distinct(),
        "copies",
    )
    hashed = found.join(small(copies.select("doc_id", "key")), ["doc_id", "key"], "left_anti").select(
        "doc_id", "key", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes")
    )
    marks = (
        hashed.mapInArrow(_anchors, "anchor long, doc_id long, at int, settled boolean")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_repeated_anchors, "doc_id long, at int")
        .groupBy("doc_id")
        .agg(F.collect_set("at").alias("marks"))
    )
    candidates = written(marks.mapInArrow(_candidates, _STRETCHES), "candidates")
    starts = (
        hashed.join(small(candidates), "doc_id")
        .mapInArrow(_windows, "h1 long, h2 long, doc_id long, at int, key long, settled boolean")
        .repartition("h1", "h2")
        .sortWithinPartitions("h1", "h2", "doc_id", "at")
        .mapInArrow(_later, "doc_id long, key long, at int")
        .groupBy("doc_id", "key")
        .agg(F.collect_set("at").alias("starts"))
    )
    whole = copies.select(
        "doc_id", "key", F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).alias("stretches")
    )
    return written(starts.mapInArrow(_cuts, _CUT_STRETCHES).union(whole), "cuts")


def _without(found: Column, cuts: Column) -> Column:
    """The words outside the cuts."""

    def gap(k: Column) -> Column:
        begin = F.when(k == 0, 0).otherwise(cuts[F.greatest(k - 1, F.lit(0))]["b"])
        end = F.when(k == F.size(cuts), F.size(found)).otherwise(
            cuts[F.least(k, F.size(cuts) - 1)]["a"]
        )
        return F.slice(found, begin + 1, F.greatest(end - begin, F.lit(0)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(cuts)), gap))


#: Columns the join adds; no table has these names.
_ID, _KEY, _CUTS, _CUT = "_clickloom_id", "_clickloom_key", "_clickloom_cuts", "_clickloom_cut"


def _cut_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct of n_words, n_removed and kept."""
    stretches = small(repeated_stretches(docs)).select(
        F.col("doc_id").alias(_ID), F.col("key").alias(_KEY), F.col("stretches").alias(_CUTS)
    )
    cuts = F.col(_CUTS)
    gone = F.aggregate(cuts, F.lit(0).cast("bigint"), lambda n, c: n + c["b"] - c["a"])
    cut = let(
        words(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.coalesce(gone, F.lit(0).cast("bigint")).alias("n_removed"),
            F.array_join(F.when(cuts.isNull(), w).otherwise(_without(w, cuts)), " ").alias("kept"),
        ),
    )
    own = (F.col(_KEY) == 0) | (F.col(_KEY) == _digest(words(docs["text"])))
    joined = docs.join(stretches, (docs["doc_id"].cast("bigint") == stretches[_ID]) & own, "left")
    return joined.withColumn(_CUT, cut).drop(_ID, _KEY, _CUTS)


def removed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept`` (the words that stay, joined by one space) for every row.

    A word goes if a window of 20 consecutive words over it also starts earlier:
    in a document of smaller doc_id, or further up in the same one.  Windows are
    those of the input.  Null and short texts lose nothing; an empty table stays empty.
    Columns of ``docs`` with those three names are replaced.
    """
    names = ("n_words", "n_removed", "kept")
    return _cut_rows(docs.drop(*names)).withColumns({n: F.col(f"{_CUT}.{n}") for n in names}).drop(_CUT)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text``; texts that lose nothing stay as they are.

    ``n_chars``, if there, is the new text's length.
    """
    changed, kept = F.col(f"{_CUT}.n_removed") > 0, F.col(f"{_CUT}.kept")
    new = {"text": kept, "n_chars": F.length(kept).cast("bigint")}
    return _cut_rows(docs).select(
        *(
            F.when(changed, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(f"`{c}`")
            for c in docs.columns
        )
    )
