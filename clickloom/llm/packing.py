"""Best-fit packing of tokenised documents into sequences of fixed length.

Only lengths matter for packing and there are at most ``capacity`` of them, so
the plan is made from their histogram: patterns of lengths, each with the number
of sequences that follow it.  Sums of one, two and three lengths are indexed under
their counts.  For the longest length left, pieces that fill the gap beside it
exactly are looked up in the index; where there are none, the longest piece that
fits goes in and the gap that remains is looked up again.
Pieces then find their sequence by their rank among pieces of equal length, so
no piece passes through the driver.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import written
from clickloom.llm.hashing import by_bytes

CAPACITY = 1024
END_ID = 2
#: Fixed values of the public byte-level vocabulary: its one special token.
SPECIAL = {"<|endoftext|>": 50256}

#: Chunks that can be tokenised one by one where no other white space occurs:
#: no pre-token of the vocabulary's pattern runs from another character into white space.
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_ODD_SPACE = re.compile(r"[^\S \n]")
_CACHED_CHUNKS = 300_000
#: Longer chunks are not remembered.
_LONG = 1 << 10


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class _Chunks(dict):
    """Ids of chunks as little-endian 32-bit bytes, worked out at first sight."""

    def __init__(self, encode):
        self._encode = encode

    def __missing__(self, chunk: str) -> bytes:
        found = array("I", self._encode(chunk)).tobytes()
        if len(chunk) <= _LONG:
            if len(self) >= _CACHED_CHUNKS:
                self.clear()
            self[chunk] = found
        return found


def encoder(vocabulary: bytes):
    """Text to the bytes of its ids, as the public tokenizer with its special token gives them."""
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    encoding = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
    )
    chunks = _Chunks(encoding.encode_ordinary)

    def encode(text: str) -> bytes:
        if any(s in text for s in SPECIAL):
            return array("I", encoding.encode(text, allowed_special="all")).tobytes()
        if _ODD_SPACE.search(text):
            return array("I", encoding.encode_ordinary(text)).tobytes()
        return b"".join([chunks[c] for c in _CHUNK.findall(text)])

    return encode


def pieces(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Every document's ids, an end id after them, cut where longer than ``capacity``.

    One row per piece: doc_id, piece (from 0), start, length, ids_crc32, and the
    ids if asked for.  A longer document is cut into full pieces with the rest
    in front.  Null text counts as empty: its one piece is the end id.
    """
    spark = docs.sparkSession
    with open(vocabulary or default_vocabulary(), "rb") as file:  # the driver's own; tasks get its bytes
        shipped = spark.sparkContext.broadcast(file.read())
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    end = array("I", [end_id]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shipped.value)
        for batch in by_bytes(batches, "text"):
            rows: list[tuple] = []
            ids: list[np.ndarray] = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                coded = encode(text.as_py() or "") + end
                n = len(coded) // 4
                begin, nth = 0, 0
                while begin < n:
                    stop = begin + ((n - begin - 1) % capacity + 1)
                    part = coded[4 * begin : 4 * stop]
                    rows.append((doc_id.as_py(), nth, begin, stop - begin, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
                    begin, nth = stop, nth + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, schema)


class Sums:
    """Which of the lengths that are left make up a sum: one of them, two or three.

    Pairs are indexed by their sum, and a triple is a length with a pair of the
    rest.  What runs out never comes back, so pairs of it are dropped for good when they are met.
    """

    def __init__(self, left: np.ndarray):
        self.left = left
        self.lengths = np.flatnonzero(left)[::-1]
        self.spent = np.zeros(len(left), dtype=bool)
        self._pairs: dict[int, list[tuple[int, int]]] = {}

    def take(self, lengths: np.ndarray, n: np.ndarray) -> None:
        self.left[lengths] -= n
        self.spent[lengths] = self.left[lengths] == 0

    def _pair(self, total: int) -> tuple[int, int] | None:
        """The pair with the longest piece that has this sum."""
        left, spent = self.left, self.spent
        pairs = self._pairs.get(total)
        if pairs is None:
            longer = self.lengths[(2 * self.lengths >= total) & (self.lengths < total)]
            longer = longer[left[total - longer] > 0]
            pairs = self._pairs[total] = [(int(a), int(total - a)) for a in longer[::-1]]
        while pairs and (spent[pairs[-1][0]] or spent[pairs[-1][1]]):
            pairs.pop()
        return next(((a, b) for a, b in reversed(pairs) if left[a] and left[b] > (a == b)), None)

    def making(self, total: int) -> tuple[int, ...] | None:
        """As few pieces as can be, up to three, that are left and have this sum."""
        left = self.left
        if left[total]:
            return (total,)
        found = self._pair(total)
        if found:
            return found
        for a in self.lengths[(3 * self.lengths >= total) & (self.lengths < total - 1)].tolist():
            if left[a]:
                left[a] -= 1
                found = self._pair(total - a)
                left[a] += 1
                if found:
                    return (a, *found)
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences follow each; every piece is placed once.

    From the longest length on: where pieces that are left fill the gap beside it exactly, these go
    in, in as many sequences as there are pieces for.  Where none do, the longest
    that fits goes in, and the gap that remains is looked up.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] += n
    sums = Sums(left)
    patterns: list[tuple[tuple[int, ...], int]] = []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            pattern, room = [longest], capacity - longest
            left[longest] -= 1
            while room:
                parts = sums.making(room)
                if parts is None:
                    fitting = np.flatnonzero(left[1 : room + 1])
                    if not len(fitting):
                        break
                    parts = (int(fitting[-1]) + 1,)
                pattern += parts
                np.subtract.at(left, list(parts), 1)
                room -= sum(parts)
            lengths, needs = np.unique(pattern, return_counts=True)
            left[lengths] += needs
            times = int((left[lengths] // needs).min())
            sums.take(lengths, times * needs)
            patterns.append((tuple(pattern), times))
    return patterns


#: Pieces are ranked within their length in groups; so many pieces of any length to a group number.
_RANKED_TOGETHER = 10_000


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (pieces with doc_id, piece, length) with ``sequence_id`` and ``offset`` for every row.

    Columns of those two names are replaced.  Repeated rows each get a place of their own.
    """
    cut = written(cut.drop("sequence_id", "offset"), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places, first = [], 0
    taken: dict[int, int] = {}
    for pattern, times in plan(counts, capacity):
        offset = 0
        for length in pattern:
            rank = taken.get(length, 0)
            places.append((length, rank, rank + times, first - rank, offset))
            taken[length] = rank + times
            offset += length
        first += times
    spark = cut.sparkSession
    where = spark.createDataFrame(
        places, "_length long, _from long, _to long, _shift long, offset long"
    )
    groups = max(1, sum(counts.values()) // _RANKED_TOGETHER)
    keyed = cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    sizes = keyed.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    before = sizes.select(
        F.col("length").alias("_size"),
        F.col("_group").alias("_of"),
        (
            F.sum("_n").over(Window.partitionBy("length").orderBy("_group")) - F.col("_n")
        ).alias("_before"),
    )
    within = F.row_number().over(Window.partitionBy("length", "_group").orderBy("doc_id", "piece")) - 1
    ranked = keyed.withColumn("_within", within).join(
        before, (F.col("length") == F.col("_size")) & (F.col("_group") == F.col("_of"))
    )
    rank = F.col("_before") + F.col("_within")
    return (
        ranked.join(
            F.broadcast(where),  # a few rows for each of at most `capacity` lengths
            (F.col("length") == F.col("_length")) & (rank >= F.col("_from")) & (rank < F.col("_to")),
        )
        .withColumn("sequence_id", F.col("_shift") + rank)
        .select(*cut.columns, "sequence_id", "offset")
    )


def packed_documents(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Documents as pieces with their places in sequences of at most 1024 tokens; an empty table gives none."""
    return packed(pieces(docs, vocabulary, with_ids=with_ids))
