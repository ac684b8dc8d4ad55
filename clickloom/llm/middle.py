"""Fill-in-middle transformation, with cuts found in a Roaring-style set of unit boundaries.

A text's units are its lines.  The offsets (in code points) where a unit may
begin or end are kept as a compressed set: 65,536 offsets to a container, each
an array, a bitmap or runs, whichever takes least room, with the cumulative
number of boundaries before each container.  The place of a cut after k units
is the k-th boundary: a search among the cumulative numbers finds the
container, a select inside it the offset.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.hashing import by_bytes

#: Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Percent of texts that are transformed, and of these in the order suffix, prefix, middle.
FIM_RATE, SPM_RATE = 100, 50
_WIDTH = 1 << 16
_WORDS = _WIDTH // 64


class ArrayContainer:
    """Sorted 16-bit numbers."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit a number, with the number of bits before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(_WIDTH, dtype=np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        held = int(self.words[word])
        for _ in range(k - int(self.before[word])):
            held &= held - 1
        return word * 64 + (held & -held).bit_length() - 1


class RunContainer:
    """First numbers of runs of consecutive ones, with how many numbers come before each run."""

    def __init__(self, low: np.ndarray, heads: np.ndarray):
        self.first = low[heads].astype(np.uint16)
        self.before = heads

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for sorted distinct numbers below 65,536."""
    heads = np.concatenate([[0], np.flatnonzero(np.diff(low) != 1) + 1])
    sizes = {RunContainer: 4 * len(heads), ArrayContainer: 2 * len(low), BitmapContainer: 8 * _WORDS}
    kind = min(sizes, key=sizes.get)
    return RunContainer(low, heads) if kind is RunContainer else kind(low)


class Boundaries:
    """The boundaries of a text's lines: 0, and the end of every line."""

    def __init__(self, text: str):
        self.keys: list[int] = []
        self.containers: list = []
        self.upto: list[int] = []
        count = 0
        for key in range(len(text) // _WIDTH + 1):
            begin = key * _WIDTH  # offsets from here on; the one after a line feed is a boundary
            part = text[max(begin - 1, 0) : begin + _WIDTH - 1]
            points = np.frombuffer(part.encode("utf-32-le"), np.uint32)
            low = np.flatnonzero(points == 10) + (1 if not key else 0)
            more = [0] if not key else []
            last = len(text) - begin  # where the text ends, if here and not after a line feed
            end = [last] if 0 <= last < _WIDTH and text[-1:] not in ("", "\n") else []
            low = np.concatenate([more, low, end]).astype(np.int64)
            if len(low):
                self.keys.append(key)
                self.containers.append(container(low))
                count += len(low)
                self.upto.append(count)

    def __len__(self) -> int:
        return self.upto[-1]

    def select(self, k: int) -> int:
        """The offset of boundary ``k``, counted from 0."""
        at = bisect_right(self.upto, k)
        return self.keys[at] * _WIDTH + self.containers[at].select(k - (self.upto[at - 1] if at else 0))


def _draws(seed: int) -> list[Column]:
    """Four numbers for each row, from the digest of the seed and its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [
        F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)
    ]


def transformed(docs: DataFrame, seed: int = SEED, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs``.

    ``n`` is the number of lines; the form is psm, spm or plain, where output is
    the text itself and the two counts of code points are null.  Empty texts,
    texts that hold one of the marks, and those the rate leaves out are plain.  A null
    text counts as empty.  Cuts depend on doc_id alone besides the text, so rows
    that repeat an id are cut alike if their texts are, and rows without an id as if it were the empty
    string.  Other columns are left out; an empty table gives none.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            out: list[tuple] = []
            draws = zip(*(batch.column(f"h{k}").to_pylist() for k in (1, 2, 3, 4)))
            for text, (h1, h2, h3, h4) in zip(batch.column("text"), draws):
                text = text.as_py() or ""
                edges = Boundaries(text)
                n = len(edges) - 1
                if not text or h3 % 100 >= fim_rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
                    out.append((n, "plain", None, None, text))
                    continue
                one, other = h1 % (n + 1), h2 % (n + 1)
                a, b = edges.select(min(one, other)), edges.select(max(one, other))
                if h4 % 100 < spm_rate:
                    form, made = "spm", f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
                else:
                    form, made = "psm", f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"
                out.append((n, form, a, b - a, made))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), *_draws(seed)).mapInArrow(
        cut, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from; null if either is null.

    A text that holds a mark is plain, so each mark stands once in the other forms.
    """
    first = F.substring_index(output, MIDDLE, 1)
    middle = F.substring_index(output, MIDDLE, -1)

    def between(mark: str, stop: str) -> Column:
        return F.substring_index(F.substring_index(first, mark, -1), stop, 1)

    parts = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form.isin("psm", "spm"), parts)
