"""Jaccard join on word n-grams: a blocked sparse product of the document by n-gram incidence.

A document is the set of its distinct 5-word shingles (64-bit hashes).  Two link
when their sets' Jaccard similarity is 0.75 or more.

Documents with equal sets become one row of the incidence matrix.  Columns are
put in one order for all documents: shingles that many documents hold last, otherwise by
hash.  Two linked documents share a shingle among the first ``n - ceil(0.75 n) + 1``
of each (the prefix), so only prefixes are multiplied at first:

* Columns with few documents: all pairs in a column, overlaps added up over columns.
  A pair is dropped if what it shares so far and all that lies beyond the prefixes
  cannot reach the overlap its sizes ask for.
* Columns with many documents: no pairs.  The column's documents are tied
  to one of them.  (Pairs that share such a column are tied whatever the sums say, so
  the sums need not count it.)

What remains falls into connected blocks, so that linked documents are always in
one block.  The product over whole sets is taken block by block, large blocks in
tiles of bounded size, and only enough links to connect each tile come out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import small, written
from clickloom.llm.graph import components, forest
from clickloom.llm.hashing import Windows, by_bytes, flat, lower_word_hashes, mixed

SHINGLE = 5
PERCENT = 75
#: Columns with more prefixes than this are put last in the order.
FEW = 32
#: Columns that turn out to hold more than this are tied together, not paired.
MANY = 4 * FEW
#: At most so many columns are put last, those of the most documents; any choice gives the same links.
MOST_LAST = 1 << 20
#: A tile holds documents of about this many shingles, each document counting 256 more.
TILE = 1 << 18
#: Texts of about so many bytes are cut to shingles at a time.
PORTION = 1 << 21


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    values, begins, sizes = lower_word_hashes(texts)
    windows = Windows(values)
    every = windows.at(np.arange(max(0, len(values) - SHINGLE + 1)), SHINGLE).view(np.int64)
    found = []
    for begin, size in zip(begins.tolist(), sizes.tolist()):
        if size >= SHINGLE:
            own = np.sort(every[begin : begin + size - SHINGLE + 1])
            new = own[1:] != own[:-1]
            if not new.all():
                own = own[np.concatenate([[True], new])]
        else:
            own = windows.at(np.full(min(size, 1), begin), size).view(np.int64)
        found.append(own)
    return found


def _lists(parts: list[np.ndarray]) -> pa.Array:
    """A list array of these arrays of 64-bit numbers."""
    offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.int64), *parts]))


def prefix_length(n):
    """How many of n shingles two linked documents must share one of, each in its own order."""
    return n - (PERCENT * n + 99) // 100 + 1


def _prefix_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents hold a shingle near the front, half a prefix beyond the prefix included."""
    for batch in by_bytes(batches, "text"):
        sets = [s[: 3 * prefix_length(len(s)) // 2] for s in shingle_sets(batch.column("text")) if len(s)]
        token, n = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(n)], ["token", "n"])


def _common_shingles(texts: DataFrame) -> np.ndarray:
    """The shingles to put last, sorted."""
    counts = written(
        texts.select("text").mapInArrow(_prefix_counts, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > FEW),
        "common",
    )
    rows = counts.count()
    if rows > MOST_LAST:
        enough = counts.agg(F.percentile_approx("n", 1 - MOST_LAST / 2 / rows, 100_000)).first()[0]
        counts = counts.where(F.col("n") > enough)
    return np.sort(counts.select("token").toPandas()["token"].to_numpy(np.int64))


def _pairs_in_columns(token: np.ndarray, rep: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Of rows sorted by token: pairs of documents in one column, how many of these columns they
    share, and how many they must share in all to be able to link."""
    begins = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    sizes = np.diff(np.concatenate([begins, [len(token)]]))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in np.unique(sizes[sizes > 1]):
        heads = begins[sizes == size]
        for gap in range(1, size):  # a column's documents against those `gap` further on
            i = (heads[:, None] + np.arange(size - gap)).ravel()
            left.append(i)
            right.append(i + gap)
    i, j = np.concatenate(left), np.concatenate(right)
    near = 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
    i, j = i[near], j[near]
    swap = rep[i] > rep[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    order = np.lexsort((rep[j], rep[i]))
    i, j = i[order], j[order]
    new = np.ones(len(i), dtype=bool)
    new[1:] = (rep[i][1:] != rep[i][:-1]) | (rep[j][1:] != rep[j][:-1])
    head = np.flatnonzero(new)
    shared = np.diff(np.concatenate([head, [len(i)]]))
    i, j = i[head], j[head]
    beyond = np.maximum(n[i] - prefix_length(n[i]), n[j] - prefix_length(n[j]))
    needed = -(-PERCENT * (n[i] + n[j]) // (100 + PERCENT)) - beyond
    columns = (rep[i], rep[j], needed, shared)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["u", "v", "needed", "shared"])


def _ties(hub: int, reps: np.ndarray) -> pa.RecordBatch:
    """Every document of a column tied to one of them; kept whatever it shares elsewhere."""
    one = np.ones(len(reps), dtype=np.int64)
    columns = (np.minimum(hub, reps), np.maximum(hub, reps), one, one)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["u", "v", "needed", "shared"])


def _column_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token: pairs from columns of up to ``MANY`` documents, ties from larger ones.

    The last column of a batch waits for the next batch, as at most ``MANY`` rows or its one hub.
    """
    held = [np.zeros(0, np.int64)] * 3
    hot: tuple[int, int] | None = None  # token and hub of a large column that may go on
    for batch in batches:
        rows = [batch.column(c).to_numpy().astype(np.int64) for c in ("token", "rep", "n")]
        if hot is not None:
            more = int(np.searchsorted(rows[0], hot[0], side="right"))
            if more:
                yield _ties(hot[1], rows[1][:more])
            rows = [r[more:] for r in rows]
            if len(rows[0]):
                hot = None
        rows = [np.concatenate(x) for x in zip(held, rows)]
        token, rep, n = rows
        if not len(token):
            continue
        begins = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        sizes = np.diff(np.concatenate([begins, [len(token)]]))
        for begin, size in zip(begins[sizes > MANY], sizes[sizes > MANY]):
            yield _ties(int(rep[begin]), rep[begin + 1 : begin + size])
        last = begins[-1]
        if sizes[-1] > MANY:
            hot = (int(token[last]), int(rep[last]))
            held = [np.zeros(0, np.int64)] * 3
        else:
            held = [r[last:] for r in rows]
        few = np.repeat(sizes <= MANY, sizes)
        few[last:] = False
        yield _pairs_in_columns(token[few], rep[few], n[few])
    if len(held[0]):
        yield _pairs_in_columns(*held)


def _tile_links(group: pa.Table) -> pa.Table:
    """Exact overlaps of the documents of one tile pair; edges that connect what links."""
    reps = group.column("rep").to_numpy()
    side = group.column("side").to_numpy()
    order = np.lexsort((reps, side))
    values, begins, sizes = flat(group.column("shingles").combine_chunks())
    rows = np.repeat(np.arange(len(order)), sizes[order])
    tokens = np.concatenate([values[begins[k] : begins[k] + sizes[k]] for k in order]) if len(rows) else values
    n, reps, side = sizes[order], reps[order], side[order]
    _, column, held = np.unique(tokens, return_inverse=True, return_counts=True)
    column, rows = (x[held[column] > 1] for x in (column, rows))
    _, column = np.unique(column, return_inverse=True)
    half = int(np.searchsorted(side, 1)) or len(n)  # one side only: the tile against itself
    first, second = slice(0, half), slice(half, len(n)) if half < len(n) else slice(0, half)
    overlap = np.zeros((half, len(n[second])), dtype=np.float32)
    width = max(64, (1 << 22) // max(len(n), 1))
    width = min(width, int(column.max(initial=0)) + 1)  # no wider than what there is to multiply
    by_column = np.argsort(column, kind="stable")
    column, rows = column[by_column], rows[by_column]
    edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + width + 1, width))
    for block, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        dense = np.zeros((len(n), width), dtype=np.float32)
        dense[rows[a:b], column[a:b] - block * width] = 1
        overlap += dense[first] @ dense[second].T
    both = n[first][:, None] + n[second][None, :]
    overlap = overlap.astype(np.int64)  # whole numbers so far; a hundred times them need not be, as floats
    linked = 100 * overlap >= PERCENT * (both - overlap)
    i, j = np.nonzero(linked & (overlap > 0))
    u, v = reps[first][i], reps[second][j]
    node, root = forest(u, v) if len(u) else (u, v)
    return pa.table({"u": pa.array(node, pa.int64()), "v": pa.array(root, pa.int64())})


#: Documents of one block and size are ranked in groups; so many documents of any block to a group number.
RANKED_TOGETHER = 1 << 20
LEAST_GROUPS = 4


def _tiled(sized: DataFrame) -> DataFrame:
    """``sized`` (rep, root, n, written) with ``tile``: a block's documents in order of size, cut by their shingles.

    Only the counts of groups of equal size are summed in order; a document's place is its rank in its group.
    """
    groups = max(LEAST_GROUPS, sized.count() // RANKED_TOGETHER)
    keyed = sized.withColumn("group", F.pmod(F.xxhash64("rep"), F.lit(groups)))
    weight = F.col("n") + 256
    counts = keyed.groupBy("root", "n", "group").agg((F.count("*") * weight).alias("own"))
    upto = F.sum("own").over(Window.partitionBy("root").orderBy("n", "group"))
    before = counts.select("root", "n", "group", (upto - F.col("own")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("root", "n", "group").orderBy("rep")) - 1
    return keyed.withColumn("rank", rank).join(before, ["root", "n", "group"]).select(
        "rep", "root", F.floor((F.col("before") + F.col("rank") * weight) / TILE).alias("tile"), "n"
    )


def linked_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` with an id.

    ``component_id`` is the smallest doc_id that links lead to.  A-Z is lower-cased;
    with fewer than five words, the whole sequence is the one shingle; null or
    wordless texts have none and link with nothing.  Repeated rows of one doc_id are
    one document, linked by any of them.  Rows with a null id are left out here.
    """
    texts = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    spark = docs.sparkSession
    last = spark.sparkContext.broadcast(_common_shingles(texts))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", PORTION):
            sets = shingle_sets(batch.column("text"))
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            every = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            at = np.searchsorted(last.value, every)
            common = np.zeros(len(every), dtype=bool)
            if len(last.value):
                common = last.value[np.minimum(at, len(last.value) - 1)] == every
            ends = np.cumsum(sizes)
            begins = ends - sizes
            with np.errstate(over="ignore"):
                d1, d2 = (
                    np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(x))])
                    for x in (every.view(np.uint64), ~every.view(np.uint64))
                )
                d1, d2 = d1[ends] - d1[begins], d2[ends] - d2[begins]
            lengths = np.where(sizes > 0, prefix_length(sizes), 0)
            upto = np.concatenate([[0], np.cumsum(common)])
            some = upto[begins + lengths] > upto[begins]
            prefixes, n_common = [], np.zeros(len(sets), np.int64)
            for k, (s, length) in enumerate(zip(sets, lengths.tolist())):
                if some[k]:
                    own = common[begins[k] : ends[k]]
                    rest = s[~own]
                    n_common[k] = max(0, length - len(rest))
                    s = np.concatenate([rest, s[own]])
                prefixes.append(s[:length])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array(d1.view(np.int64)),
                    pa.array(d2.view(np.int64)),
                    pa.array(n_common),
                    _lists(prefixes),
                ],
                ["doc_id", "n", "d1", "d2", "common", "prefix"],
            )

    rows = written(
        texts.mapInArrow(sketch, "doc_id long, n long, d1 long, d2 long, common long, prefix array<long>"),
        "prefixes",
    )
    # one row of the matrix for each distinct set
    sets = rows.where("n > 0").groupBy("doc_id").agg(F.min(F.struct("n", "d1", "d2")).alias("s"))
    sets = sets.select("doc_id", "s.*")
    same = written(
        sets.groupBy("n", "d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
        .where("copies > 1"),
        "same",
    )
    members = written(
        sets.join(small(same), ["n", "d1", "d2"], "left").select(
            "doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")
        ),
        "members",
    )
    copies = members.where("doc_id != rep").select("doc_id")
    matrix = rows.where("n > 0").join(small(copies), "doc_id", "left_anti")
    few = matrix.select(
        F.col("doc_id").alias("rep"),
        F.col("n").cast("int").alias("n"),
        F.explode(F.slice("prefix", F.lit(1), (F.size("prefix") - F.col("common")).cast("int"))).alias("token"),
    )
    counted = (
        few.repartition("token")
        .sortWithinPartitions("token")
        .mapInArrow(_column_pairs, "u long, v long, needed long, shared long")
        .groupBy("u", "v")
        .agg(F.sum("shared").alias("shared"), F.min("needed").alias("needed"))
        .where("shared >= needed")
        .select("u", "v")
    )
    step = math.log(100 / PERCENT) * 1.01  # sizes that can link are never two classes apart
    many = matrix.where("common > 0").select(
        F.col("doc_id").alias("rep"),
        F.floor(F.log("n") / step).alias("size_class"),
        F.explode(F.expr("slice(prefix, cast(size(prefix) - common + 1 as int), cast(common as int))")).alias("token"),
    )
    hubs = many.groupBy("token", "size_class").agg(F.min("rep").alias("hub"))
    ties = many.join(hubs, ["token", "size_class"]).where("rep != hub").select("rep", "hub").distinct()
    next_class = hubs.select("token", (F.col("size_class") - 1).alias("size_class"), F.col("hub").alias("above"))
    steps = hubs.join(next_class, ["token", "size_class"]).select("hub", "above").distinct()
    blocks = written(components(counted.union(ties).union(steps)), "blocks")

    sized = written(
        blocks.join(members.select(F.col("doc_id").alias("node"), "n"), "node").select(
            F.col("node").alias("rep"), "root", "n"
        ),
        "sized",
    )
    tiled = written(_tiled(sized), "tiles")
    spans = tiled.groupBy("root", "tile").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    later = spans.select("root", F.col("tile").alias("other"), F.col("low").alias("other_low"))
    together = (
        spans.join(later, "root")
        .where((F.col("tile") <= F.col("other")) & (100 * F.col("high") >= PERCENT * F.col("other_low")))
        .select("root", "tile", "other")
    )
    sides = together.select(
        "root",
        F.explode(F.array_distinct(F.array("tile", "other"))).alias("tile"),
        F.col("tile").alias("one"),
        "other",
    )
    placed = tiled.join(sides, ["root", "tile"]).select(
        "rep", "root", "one", "other", (F.col("tile") != F.col("one")).cast("int").alias("side")
    )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", PORTION):
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), _lists(shingle_sets(batch.column("text")))], ["rep", "shingles"]
            )

    chosen = small(tiled.select("rep"))
    full = (
        texts.join(chosen, texts["doc_id"] == chosen["rep"])
        .select("rep", "text")
        .mapInArrow(whole, "rep long, shingles array<long>")
    )
    links = (
        placed.join(full, "rep")
        .groupBy("root", "one", "other")
        .applyInArrow(_tile_links, "u long, v long")
    )
    found = components(links).select(F.col("node").alias("rep"), F.col("root").alias("component"))
    labelled = members.join(found, "rep", "left").select(
        F.col("doc_id").alias("_id"), F.coalesce("component", "rep").alias("component"), F.col("n").alias("_n")
    )
    return rows.select("doc_id").join(labelled, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id",
        F.coalesce("_n", F.lit(0).cast("bigint")).alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest id of its component; null ids stay."""
    groups = linked_components(docs)
    gone = groups.where("component_id != doc_id").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone["_gone"], "left_anti")
