"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The bytes of pre-tokens are a linked list.  Every pair of neighbours that the
vocabulary can merge stands in the bucket of its rank, as the position of its
left part.  A bitmap tells which buckets hold anything, one above it which of
its 64-bit words do, and one more which of those, so finding the lowest rank
takes three find-first-sets however long the list is.  A merge leaves the
entries of its old neighbours behind; the pair at their position has another
rank by then, so they are known to be stale and skipped.
"""

from __future__ import annotations

import base64
import re
import string
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.hashing import by_bytes

#: Runs that can be split one by one where no other white space occurs: no pre-token
#: goes from another character on into white space.
_RUN = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_ODD_SPACE = re.compile(r"[^\S \n]")
#: Bytes of remembered runs and their ids, with what a dictionary needs for each.
_REMEMBERED = 256 << 20
_EACH = 250
#: Longer runs are not remembered.
_LONG = 1 << 10
#: Characters of pre-tokens that go through one queue, one pre-token at least.
_TOGETHER = 1 << 19
#: Buckets of so many positions are merged at once.
_MANY = 96


class _Merges:
    """The rank of any two tokens that make a third, by both ids in one number."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        self.of = found
        self._keys = np.sort(np.fromiter(found, np.int64, len(found)))
        self._ranks = np.array([found[k] for k in self._keys.tolist()] or [-1], dtype=np.int32)

    def of_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of tokens, -1 where there is none; a stop (-1) goes with nothing."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._keys, keys), max(len(self._keys) - 1, 0))
        same = self._keys[at] == keys if len(self._keys) else np.zeros(len(keys), bool)
        return np.where(same & (left >= 0) & (right >= 0), self._ranks[at], -1)


class BytePairs:
    """A vocabulary of byte strings by rank, where a token's rank is its id.

    ``stand_ins`` says which characters the pattern is to take for others.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, stand_ins: dict[int, int] | None = None):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary needs every single byte")
        self.ranks = ranks
        self.texts = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.stand_ins = stand_ins or {}
        #: Whether a run of ASCII letters, and one behind a space, is one match.
        self._plain = all(self.pattern.findall(x) == [x] for x in (string.ascii_letters, f" {string.ascii_letters}"))
        self._single = np.array([ranks[bytes([b])] for b in range(256)])
        self._of_bytes = np.array(
            [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        ).reshape(256, 256)
        self._merges = _Merges(ranks)
        # the queue: buckets by rank, a bit for each bucket that holds anything, a bit for each word of those
        size = max(ranks.values()) + 1
        self._buckets: list[list[int]] = [[] for _ in range(size)]
        self._low = [0] * (-(-size // 64))
        self._middle = [0] * (-(-size // 4096))
        self._runs: dict[str, bytes] = {}
        self._older_runs: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        self._older_pieces: dict[str, bytes] = {}
        self._taken = 0

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of pre-tokens, all through one queue: merges by lowest rank, leftmost first, until none is left.

        Pre-tokens lie end to end with a stop before, between and after them, which nothing merges with.
        """
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        flat = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8)
        stops = np.concatenate([[0], np.cumsum(sizes + 1)])
        tokens, pair = self._single[flat], np.full(len(flat), -1)
        pair[:-1] = self._of_bytes[flat[:-1], flat[1:]]
        tokens[stops], pair[stops], pair[stops[1:] - 1] = -1, -1, -1
        whole = [self.ranks.get(p) for p in pieces]
        for k, rank in enumerate(whole):  # a pre-token that is a token is that token, however it would be merged
            if rank is not None:
                inside = slice(stops[k] + 1, stops[k + 1])
                tokens[inside], pair[inside] = -1, -1
                tokens[stops[k] + 1] = rank
        left = self._merge(tokens, pair)
        kept = np.concatenate([[0], np.cumsum(left >= 0)])
        blob = left[left >= 0].astype("<u4").tobytes()
        begins, ends = (4 * kept[stops[:-1]]).tolist(), (4 * kept[stops[1:]]).tolist()
        return [blob[a:b] for a, b in zip(begins, ends)]

    def _merge(self, start: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """The tokens that are left, with -1 for what was merged into its left neighbour; ``ranks`` are those of the pairs."""
        merges, buckets, low, middle = self._merges.of.get, self._buckets, self._low, self._middle
        n = len(start)
        tokens, after, before, pair = (
            array("i", x.astype(np.int32).tobytes()) for x in (start, np.arange(1, n + 1), np.arange(-1, n - 1), ranks)
        )
        lists = tuple(np.frombuffer(x, np.int32) for x in (tokens, after, before, pair))
        top = 0  # a bit for each word of ``middle``
        starts = np.flatnonzero(ranks >= 0)
        starts = starts[np.argsort(ranks[starts], kind="stable")]
        edges = np.flatnonzero(np.diff(ranks[starts], prepend=-1))
        fresh = [(r, p.tolist()) for r, p in zip(ranks[starts[edges]].tolist(), np.split(starts, edges[1:]))]
        while True:
            for rank, bucket in fresh:
                buckets[rank] = bucket
                word = rank >> 6
                low[word] |= 1 << (rank & 63)
                middle[word >> 6] |= 1 << (word & 63)
                top |= 1 << (word >> 6)
            if not top:
                return lists[0]
            word = (top & -top).bit_length() - 1
            held = middle[word]
            word = word << 6 | (held & -held).bit_length() - 1
            held = low[word]
            rank = word << 6 | (held & -held).bit_length() - 1
            bucket, buckets[rank] = buckets[rank], []
            low[word] = held & (held - 1)
            if not low[word]:
                middle[word >> 6] &= ~(1 << (word & 63))
                if not middle[word >> 6]:
                    top &= top - 1
            fresh = []
            if len(bucket) >= _MANY and (found := self._at_once(rank, np.unique(bucket), *lists)) is not None:
                for new, places in found:
                    if buckets[new]:
                        buckets[new].extend(places)
                    else:
                        fresh.append((new, places))
                continue
            bucket.sort()
            for done, left in enumerate(bucket, 1):  # its merges make longer tokens, so none comes to this rank
                if pair[left] != rank:
                    continue  # stale: one of the two was merged with its other neighbour
                gone = after[left]
                right = after[left] = after[gone]
                before[right] = left
                tokens[left], tokens[gone] = rank, -1
                pair[gone] = pair[left] = -1
                lowest = rank
                token = tokens[right]
                if token >= 0:
                    new = pair[left] = merges(rank << 32 | token, -1)
                    if new >= 0:
                        if buckets[new]:
                            buckets[new].append(left)
                        else:
                            buckets[new] = [left]
                            fresh.append((new, buckets[new]))
                        if new < lowest:
                            lowest = new
                at = before[left]
                token = tokens[at]
                if token >= 0:
                    new = pair[at] = merges(token << 32 | rank, -1)
                    if new >= 0:
                        if buckets[new]:
                            buckets[new].append(at)
                        else:
                            buckets[new] = [at]
                            fresh.append((new, buckets[new]))
                        if new < lowest:
                            lowest = new
                if lowest < rank:
                    if done < len(bucket):
                        fresh.append((rank, bucket[done:]))
                    break

    def _at_once(
        self, rank: int, places: np.ndarray, tokens: np.ndarray, after: np.ndarray, before: np.ndarray, pair: np.ndarray
    ) -> list[tuple[int, list[int]]] | None:
        """Merge a whole bucket if its order does not matter, and return what goes into which bucket; else nothing.

        The order matters where two of its pairs overlap or touch, or where a merge makes room for one of lower rank.
        """
        places = places[pair[places] == rank]
        gone = after[places]
        right, left = after[gone], before[places]
        if (pair[gone] == rank).any() or (pair[right] == rank).any():
            return None
        this = np.full(len(places), rank)
        to_right, to_left = self._merges.of_all(this, tokens[right]), self._merges.of_all(tokens[left], this)
        new = np.concatenate([to_right, to_left])
        known = new >= 0
        if (new[known] < rank).any():
            return None
        tokens[places], tokens[gone] = rank, -1
        after[places], before[right] = right, places
        pair[gone], pair[places] = -1, to_right
        pair[left] = to_left
        at, new = np.concatenate([places, left])[known], new[known]
        order = np.argsort(new, kind="stable")
        at, new = at[order], new[order]
        edges = np.flatnonzero(np.diff(new, prepend=-1))
        return [(r, p.tolist()) for r, p in zip(new[edges].tolist(), np.split(at, edges[1:]))]

    def _matches(self, run: str) -> list[str]:
        """The pre-tokens of ``run``."""
        if self._plain and (run[1:] if run[0] == " " else run).isalpha() and run.isascii():
            return [run]
        if self.stand_ins and not run.isascii() and (seen := run.translate(self.stand_ins)) != run:
            return [run[m.start() : m.end()] for m in self.pattern.finditer(seen)]
        return self.pattern.findall(run)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit numbers; a null text has none."""
        if self._taken > _REMEMBERED // 2:  # what the next half does not use is forgotten
            self._runs, self._older_runs = {}, self._runs
            self._pieces, self._older_pieces = {}, self._pieces
            self._taken = 0
        runs, pieces = self._runs, self._pieces
        lists = [(_RUN.findall(t) if not _ODD_SPACE.search(t) else [t]) if t else [] for t in texts]
        parts = [list(map(runs.get, rs)) for rs in lists]
        missing = [k for k, ps in enumerate(parts) if None in ps]
        unknown = {r for k in missing for r, p in zip(lists[k], parts[k]) if p is None}
        split = {r: self._matches(r) for r in self._new(runs, self._older_runs, unknown)}
        group: list[str] = []
        size = 0
        for piece in self._new(pieces, self._older_pieces, {p for ps in split.values() for p in ps}):
            group.append(piece)
            size += len(piece)
            if size >= _TOGETHER:
                pieces.update(zip(group, self.merged([p.encode() for p in group])))
                group, size = [], 0
        if group:
            pieces.update(zip(group, self.merged([p.encode() for p in group])))
        for run, own in split.items():
            runs[run] = pieces[own[0]] if len(own) == 1 else b"".join([pieces[p] for p in own])
        for k in missing:
            parts[k] = map(runs.get, lists[k])
        coded = list(map(b"".join, parts))
        for run, own in split.items():
            self._taken += _EACH * (1 + len(own))
            if len(run) > _LONG:  # long ones are not remembered
                del runs[run]
                for piece in own:
                    if len(piece) > _LONG:
                        pieces.pop(piece, None)
        return coded

    def _new(self, young: dict[str, bytes], older: dict[str, bytes], wanted: set[str]) -> list[str]:
        """What is not remembered; what was used before the last half moves to the young."""
        new = []
        for key in wanted.difference(young):
            found = older.get(key)
            if found is None:
                new.append(key)
            else:
                young[key] = found
                self._taken += _EACH
        return new

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes that ids stand for; an id outside the vocabulary is an error."""
        return b"".join(map(self.texts.__getitem__, ids))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def library_stand_ins() -> dict[int, int]:
    """Characters that the reference tokenizer's pattern engine puts in another class than ours does.

    The two may be of different Unicode versions.  Each such character is to stand for one that both
    take for a letter, a number, white space, or none of these.
    """
    import tiktoken

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    singles = {bytes([b]): b for b in range(256)}
    found: dict[int, int] = {}
    differ: set[str] = set()
    for kind, plain in ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", "\t")):
        engine = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=singles, special_tokens={})
        theirs = set(engine.decode(engine.encode_ordinary(every)))
        ours = set(regex.findall(kind, every))
        differ |= theirs ^ ours
        found |= {ord(c): ord(plain) for c in theirs - ours}
    return {ord(c): ord("!") for c in differ} | found


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks from the lines of a rank file: a token in base 64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


@lru_cache(maxsize=1)
def _kept(lines: bytes, pattern: str, stand_ins: tuple[tuple[int, int], ...]) -> BytePairs:
    """The vocabulary of a worker process, made once: what one task remembers serves the next."""
    return BytePairs(read_ranks(lines), pattern, dict(stand_ins))


def coded(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for every row of ``docs``.

    ``ids`` are the whole text's, as little-endian unsigned 32-bit numbers
    (``id_array`` makes an array of them), and ``decoded`` the bytes they stand
    for.  A null text counts as empty and has no ids; rows that repeat an id, or have none, are
    coded each for itself; other columns are left out, and an empty table gives none.
    """
    with open(vocabulary or default_vocabulary(), "rb") as file:  # the driver's own; tasks get its bytes
        shipped = docs.sparkSession.sparkContext.broadcast(
            (file.read(), pattern or default_pattern(), tuple(sorted(library_stand_ins().items())))
        )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _kept(*shipped.value)
        for batch in by_bytes(batches, 1, 1 << 21):
            ids = pairs.encode(batch.column(1).to_pylist())
            back = [pairs.decode(np.frombuffer(i, "<u4").tolist()) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(back, pa.binary()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        code, f"doc_id {kind}, n_tokens long, ids binary, decoded binary"
    )


def id_array(ids: Column) -> Column:
    """Packed ids as an array of numbers; null stays null."""

    def number(k: Column) -> Column:
        digits = F.hex(F.substring(ids, 4 * k + 1, F.lit(4)))
        return F.conv(F.concat(*(F.substring(digits, at, 2) for at in (7, 5, 3, 1))), 16, 10).cast("bigint")

    count = (F.octet_length(ids) / 4).cast("int")
    return F.when(count == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), count - 1), number)
    )
