"""Hashes of every window of a batch of word-hash arrays, and scans over sorted keys; for Arrow tasks."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multipliers, 5 modulo 8.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD95)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Words of more bytes than this are hashed one by one.
LONG_WORD = 128
#: What of eight bytes belongs to a word that goes on for 0 to 8 bytes.
_WITHIN = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _byte_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, together: int = 1 << 14) -> np.ndarray:
    """64-bit hashes of the stretches of bytes at ``starts``, eight bytes at a time; ``together`` fit a cache."""
    padded = np.zeros(len(data) // 8 * 8 + 16, np.uint8)
    padded[: len(data)] = data
    eights = padded.view("<u8")
    found = sizes.astype(np.uint64)
    for begin in range(0, len(starts), together):
        part = found[begin : begin + together]
        at, rest = starts[begin : begin + together], np.minimum(sizes[begin : begin + together], LONG_WORD)
        left = np.arange(len(part))
        with np.errstate(over="ignore"):
            while len(left):
                aligned, bits = at >> 3, (at & 7).astype(np.uint64) << np.uint64(3)
                eight = (eights[aligned] >> bits) | (eights[aligned + 1] << (np.uint64(64) - bits))
                part[left] = mixed(part[left] * np.uint64(BASES[1]) + (eight & _WITHIN[np.minimum(rest, 8)]))
                more = np.flatnonzero(rest > 8)
                left, at, rest = left[more], at[more] + 8, rest[more] - 8
    for k in np.flatnonzero(sizes > LONG_WORD):
        digest = hashlib.blake2b(data[starts[k] : starts[k] + sizes[k]], digest_size=8).digest()
        found[k] = int.from_bytes(digest, "little")
    return found


def lower_word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, A-Z lower-cased; start and length of each text's part.

    Null texts have no words.
    """
    lower = pc.ascii_lower(pc.fill_null(texts, ""))
    wide = pa.types.is_large_string(lower.type)
    _, offsets, data = lower.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[lower.offset :][: len(lower) + 1].astype(np.int64)
    begin, end = (int(offsets[0]), int(offsets[-1])) if len(lower) else (0, 0)
    if begin == end:
        return np.zeros(0, np.uint64), *np.zeros((2, len(lower)), np.int64)
    data = np.frombuffer(data, np.uint8)[begin:end]
    inside = (data != 32) & (data - np.uint8(9) > 4)
    borders = offsets[:-1][np.diff(offsets) > 0] - begin  # where texts begin
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[borders] = inside[borders]
    last[borders[1:] - 1] = inside[borders[1:] - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    places = np.searchsorted(starts, offsets - begin)
    return _byte_hashes(data, starts, ends - starts), places[:-1], np.diff(places)


class Windows:
    """Hashes of windows anywhere in a flat array of 64-bit word hashes (polynomials modulo 2**64)."""

    def __init__(self, values: np.ndarray, which: int = 0):
        base = BASES[which]
        n = len(values)
        powers = np.full(n + 1, base, dtype=np.uint64)
        powers[0] = 1
        self._back = np.full(n + 1, pow(base, -1, 2**64), dtype=np.uint64)
        self._back[0] = 1
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumprod(powers, out=powers)
            np.cumprod(self._back, out=self._back)
            own = mixed(values.view(np.uint64) + np.uint64(which))
            np.cumsum(own * powers[:n], out=self._sums[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self._sums[starts + length] - self._sums[starts]) * self._back[starts])


def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a list array, and start and length of each row's part; null rows are empty."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(offsets)
    if lists.null_count:
        sizes = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, sizes)
    values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    return values.to_numpy(zero_copy_only=False), offsets[:-1] - offsets[0], sizes


def portions(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose lists in ``column`` hold about ``most`` values together, one row at least."""
    for batch in batches:
        ends = np.asarray(batch.column(column).offsets.to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[begin] + most, side="right")) - 1
            stop = min(max(stop, begin + 1), batch.num_rows)
            yield batch.slice(begin, stop - begin)
            begin = stop


def give_back() -> None:
    """Freed memory back to the machine, where the C library can: a worker waits for its next task with little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def by_bytes(batches: Iterable[pa.RecordBatch], column: int | str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts in ``column`` hold about ``most`` bytes together, one row at least.

    After the last, what earlier ones took is given back.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        begin = 0
        while begin < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[begin] + most, side="right")) - 1
            stop = min(max(stop, begin + 1), batch.num_rows)
            yield batch.slice(begin, stop - begin)
            begin = stop
    give_back()


def positions(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and position in its row, for every value of rows of these sizes."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _same(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Whether each row but the first has the key of the row before."""
    same = np.ones(max(batch.num_rows - 1, 0), dtype=bool)
    for key in keys:
        column = batch.column(key).to_numpy(zero_copy_only=False)
        same &= column[1:] == column[:-1]
    return same


def _flags(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(bool)


def spread(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of a place, for rows that need no company."""
    with np.errstate(over="ignore"):
        return mixed(ids.view(np.uint64) * np.uint64(BASES[1]) + at.astype(np.uint64)).view(np.int64)


def same_keys(keys: list[np.ndarray], ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each row shares its keys with another row, and whether it is at another place than the first that has them."""
    order = np.lexsort((at, ids, *keys))
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    heads = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    first = order[heads[group]] if len(order) else order
    shared, behind = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
    shared[order] = np.diff(np.append(heads, len(order)))[group] > 1 if len(order) else False
    behind[order] = (ids[order] != ids[first]) | (at[order] != at[first])
    return shared, behind


def _after(held: pa.RecordBatch | None, batch: pa.RecordBatch) -> pa.RecordBatch:
    """``batch`` behind the row held from before."""
    return batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]


def repeats(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``keys``, those whose key another row has, and those already ``settled``.

    One row is carried from batch to batch, so a key of any number of rows takes no memory.
    """
    held = None  # the last row so far
    out = False  # whether it has been given out
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = _after(held, batch)
        same = _same(batch, keys)
        take = np.concatenate([[False], same]) | np.concatenate([same, [False]]) | _flags(batch, "settled")
        last = bool(take[-1])
        if held is not None and out:
            take[0] = False
            last = last if batch.num_rows > 1 else True
        if take.any():
            yield batch.filter(pa.array(take))
        held, out = batch.slice(batch.num_rows - 1), last


def later(batches: Iterable[pa.RecordBatch], keys: list[str], place: list[str]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``keys`` and ``place``, those of a key at another place than its first, and those ``settled``."""
    held = None
    first_place = True  # whether the row held is at its key's first place
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = _after(held, batch)
        new_key = np.concatenate([[True], ~_same(batch, keys)])
        run = np.cumsum(np.concatenate([[True], ~_same(batch, keys + place)]))
        group = np.cumsum(new_key) - 1
        first = run == run[np.flatnonzero(new_key)][group]
        if held is not None and not first_place:
            first[1:] &= group[1:] > 0
        last = bool(first[-1]) if batch.num_rows > 1 or held is None else first_place
        take = ~first | _flags(batch, "settled")
        take[0] &= held is None
        if take.any():
            yield batch.filter(pa.array(take))
        held, first_place = batch.slice(batch.num_rows - 1), last
