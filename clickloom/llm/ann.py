"""Approximate nearest neighbours by inner product, with a permutation index.

Pivots are a sample of the vectors, as many for any size of table, so that a query sees
the same share of every table.  A vector is represented by the order of
its nearest pivots, and posted in the inverted files of the first few.  A query reads
the files of its own first pivots, ranks what it finds there by footrule distance
between the two orders, and reranks the best share of each file by inner product.

Equal vectors are one entry of the index, with the smallest of their ids.  Large
files are split into blocks, each read by all the file's queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import written
from clickloom.llm.hashing import flat

NEIGHBOURS = 20
#: Pivots sampled. Files grow with the table and are split into blocks: more pivots would leave a query less of the index.
PIVOTS = 128
BLOCK = 8192
#: Length of the orders compared, files a vector is posted in, files a query reads.
PREFIX = 64
POSTED = 12
READ = 16
#: Share of a block that is reranked, and at least so many.
RERANKED = 0.35
RERANKED_LEAST = 200


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, every component a finite number."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(lists: pa.Array) -> np.ndarray:
    values, _, sizes = flat(lists)
    return values.reshape(len(sizes), -1) if len(sizes) else np.zeros((0, 0), values.dtype)


def _block(entries: pa.Table, queries: pa.Table, pivots: int) -> pa.Table:
    """The best entries of one block for each of its queries: (query, entry, score, ids)."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(entries) and len(queries):
        vectors = _matrix(entries.column("vector").combine_chunks()).astype(np.float64)
        orders = _matrix(entries.column("nearest").combine_chunks())
        uids = entries.column("uid").to_numpy()
        n, length = orders.shape
        place = np.full((pivots, n), length, dtype=np.int16)  # of each pivot in each entry's order
        place[orders.ravel(), np.repeat(np.arange(n), length)] = np.tile(np.arange(length, dtype=np.int16), n)
        own = np.arange(length, dtype=np.int16)[:, None]
        take = min(n, max(RERANKED_LEAST, int(n * RERANKED)))
        longest = np.linalg.norm(vectors, axis=1).max()
        asked = _matrix(queries.column("asked").combine_chunks()).astype(np.float64)
        for uid, vector, order in zip(
            queries.column("asker").to_numpy(), asked, _matrix(queries.column("order").combine_chunks())
        ):
            theirs = place[order]
            footrule = (np.abs(theirs - own) + theirs).sum(axis=0, dtype=np.int32)  # less a constant
            # whatever ties with the last place stays until ids are compared
            near = np.flatnonzero(footrule <= np.partition(footrule, take - 1)[take - 1])
            rough = vectors[near] @ vector
            most = 2 * (NEIGHBOURS + 1)
            if len(near) > most:
                slack = 1e-12 * longest * np.linalg.norm(vector)  # sums of one value may differ by rounding
                near = near[rough >= np.partition(rough, -most)[-most] - slack]
            scores = (vectors[near] * vector).sum(axis=1)
            best = np.lexsort((uids[near], -scores))[: NEIGHBOURS + 1]
            out.append((np.full(len(best), uid), near[best], scores[best]))
    query, entry, score = (np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else [(), (), ()]))
    return pa.table(
        {
            "query": pa.array(query, pa.int64()),
            "entry": entries.column("uid").take(pa.array(entry, pa.int64())),
            "score": pa.array(score, pa.float64()),
            "ids": entries.column("ids").take(pa.array(entry, pa.int64())),
        }
    )


def nearest(rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): up to 20 found neighbours of every query row, nearest first.

    Candidates are all rows but the query's own; equal scores go by smaller id.
    Scores are inner products in double precision.  Unusable vectors and null
    ids take no part, nor do vectors of another length than most have; of repeated rows of one id the
    smallest vector counts.
    """
    spark = rows.sparkSession
    clean = rows.select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asks")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    clean = written(clean.groupBy("id").agg(F.min("vector").alias("vector"), F.max("asks").alias("asks")), "vectors")
    lengths = clean.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = lengths["size"] if lengths else 0
    clean = clean.where(F.size("vector") == size)
    by_id = Window.partitionBy("vector").orderBy("id")
    entries = written(
        clean.select("vector", "id", F.row_number().over(by_id).alias("nth"))
        .where(F.col("nth") <= NEIGHBOURS + 1)  # no more of equal vectors can be among 20 others
        .groupBy("vector")
        .agg(F.min("id").alias("uid"), F.sort_array(F.collect_list("id")).alias("ids")),
        "entries",
    )
    sample = entries.orderBy(F.xxhash64("vector"), "uid").limit(PIVOTS).select("vector").toArrow()
    pivots = _matrix(sample.column("vector").combine_chunks()) if len(sample) else np.zeros((0, 0))
    shipped = spark.sparkContext.broadcast(pivots.astype(np.float32))
    length = min(PREFIX, len(pivots))

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = _matrix(batch.column("vector")).astype(np.float32) @ shipped.value.T
            order = np.argsort(-close, axis=1, kind="stable")[:, :length].astype(np.int16)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(order) + 1, dtype=np.int32) * length), pa.array(order.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("vector"), batch.column("ids"), lists],
                ["uid", "vector", "ids", "nearest"],
            )

    index = written(
        entries.mapInArrow(ordered, "uid long, vector array<double>, ids array<long>, nearest array<short>"), "index"
    )
    asking = written(
        clean.where("asks").select(F.col("id").alias("query_id"), "vector").join(
            entries.select("vector", "uid"), "vector"
        ).select("query_id", F.col("uid").alias("query")),
        "queries",
    )
    posted = index.select("uid", "vector", "ids", "nearest", F.explode(F.slice("nearest", 1, POSTED)).alias("pivot"))
    sizes = posted.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    lookups = index.join(asking.select(F.col("query").alias("uid")).distinct(), "uid", "left_semi").select(
        "uid", "vector", "nearest", F.explode(F.slice("nearest", 1, READ)).alias("pivot")
    )
    readers = lookups.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).alias("shifts"))
    files = sizes.join(readers, "pivot")  # a row for each pivot
    entry_side = posted.join(files, "pivot").select(
        "pivot", F.pmod(F.xxhash64("uid"), "blocks").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shifts") - 1)).alias("shift"),
        "uid", "vector", "ids", "nearest",
    )
    query_side = lookups.join(files, "pivot").select(
        "pivot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("uid"), "shifts").alias("shift"), F.col("uid").alias("asker"),
        F.col("vector").alias("asked"), F.col("nearest").alias("order"),
    )
    count = len(pivots)
    keys = ("pivot", "block", "shift")
    found = (
        entry_side.groupBy(*keys)
        .cogroup(query_side.groupBy(*keys))
        .applyInArrow(
            lambda mine, theirs: _block(mine, theirs, count),
            "query long, entry long, score double, ids array<long>",
        )
        .dropDuplicates(["query", "entry"])
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    top = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= NEIGHBOURS + 1)
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        top.join(asking, "query")
        .select("query_id", F.explode("ids").alias("vec_id"), "score")
        .where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= NEIGHBOURS)
        .select("query_id", "rank", "vec_id", "score")
    )
