"""Toxicity: a factorization machine over hashed terms.

A text is the set of its terms: lower-cased runs of letters, and their first four and
six letters, which inflected forms share.  Each kept term has a weight and a short
factor; the score adds the weights and, for every pair of terms, the product of
their factors, so that an insult together with a mention of a group can
count for more than both apart.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fold
from clickloom.llm.hashing import by_bytes, flat, positions

#: The classifier's bounds: labelled rows it is fitted on (expected), hash buckets, buckets kept.
TRAIN_ROWS = 16_000
BUCKETS = 1 << 20
KEPT = 1 << 16
#: A bucket is kept if at least so many training rows hold it, those of the most rows first; what the
#: rows are labelled plays no part, as a term may count only together with another.
MIN_ROWS = 3
FACTORS = 4
#: Passes over the rows, and steps of a batch at least, so that few rows are fitted as well.
EPOCHS = 10
STEPS = 240
BATCH = 256
RATE, FACTOR_RATE = 0.2, 0.02
#: What a weight must gain for each row that holds its term, divided by the cube of how far the term stands
#: out on its own: ordinary words stay at nothing unless the others leave something for them to explain.
LASSO = 0.3
#: Shrinkage of factors for each row that holds the term.
SHRINK = 0.03
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")


def _buckets(word: str) -> tuple[int, int, int]:
    """Buckets of a word, its first four and its first six letters."""
    return tuple(
        zlib.crc32(kind + part.encode()) % BUCKETS
        for kind, part in ((b"w", word), (b"4", word[:4]), (b"6", word[:6]))
    )


def term_rows(texts: pa.Array, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each text's distinct terms, in row order; if given, only of the sorted ``kept``, as positions in it."""
    numbers: dict[str, int] = {}
    rows, words = [], []
    for row, text in enumerate(texts.to_pylist()):
        own = {numbers.setdefault(w, len(numbers)) for w in set(_WORD.findall(text.lower()))} if text else ()
        words.extend(own)
        rows.append(len(own))
    table = np.array([_buckets(w) for w in numbers], dtype=np.int64).reshape(-1, 3)
    if kept is not None:
        at = np.minimum(np.searchsorted(kept, table), max(len(kept) - 1, 0))
        table = np.where(kept[at] == table, at, -1) if len(kept) else np.full_like(table, -1)
    row = np.repeat(np.arange(len(rows)), rows)
    terms = table[np.array(words, dtype=np.int64)] if words else np.zeros((0, 3), np.int64)
    row, terms = np.repeat(row, 3), terms.ravel()
    row, terms = row[terms >= 0], terms[terms >= 0]
    key = np.unique(row * BUCKETS + terms)
    return key // BUCKETS, key % BUCKETS


@dataclass
class Machine:
    kept: np.ndarray  # sorted buckets
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        linear = np.bincount(row, weights=self.weights[term], minlength=rows)
        pairs = np.zeros(rows)
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f]
            pairs += np.bincount(row, weights=v, minlength=rows) ** 2 - np.bincount(row, weights=v * v, minlength=rows)
        return self.bias + linear + pairs / 2

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, term = term_rows(texts, self.kept)
        return 1 / (1 + np.exp(-np.clip(self.margins(row, term, len(texts)), -30, 30)))


def fit(
    kept: np.ndarray, terms: np.ndarray, begins: np.ndarray, sizes: np.ndarray, labels: np.ndarray, seed: int = 1
) -> Machine:
    """Adaptive-step gradient descent on logistic loss, with an adaptive lasso on the weights.

    ``terms`` holds the rows' positions in ``kept``, those of a row from its ``begins`` on; rows may be empty.
    """
    rng = np.random.default_rng(seed)
    share = min(max(float(labels.mean()) if len(labels) else 0.0, 1e-3), 1 - 1e-3)
    n = len(kept)
    model = Machine(kept, float(np.log(share / (1 - share))), np.zeros(n), rng.normal(0, 0.01, (n, FACTORS)))
    held, toxic = np.zeros(n), np.zeros(n)
    for at in range(0, len(sizes), BATCH):  # batch by batch, as all terms' rows at once would be many times the terms
        row, nth = positions(sizes[at : at + BATCH])
        term = terms[begins[at : at + BATCH][row] + nth]
        held += np.bincount(term, minlength=n)
        toxic += np.bincount(term, weights=labels[at : at + BATCH][row], minlength=n)
    expected = held * share
    standing = np.abs(toxic - expected) / np.sqrt(expected + 0.1)
    penalty = LASSO / np.maximum(standing, 1) ** 3
    past_w, past_v, past_b = np.ones(n), np.ones((n, FACTORS)), 1.0
    batches = -(-len(sizes) // BATCH)
    for _ in range(max(EPOCHS, -(-STEPS // batches)) if batches else 0):
        order = rng.permutation(len(sizes))
        for begin in range(0, len(order), BATCH):
            batch = order[begin : begin + BATCH]
            row, nth = positions(sizes[batch])
            term = terms[begins[batch][row] + nth]
            margin = np.clip(model.margins(row, term, len(batch)), -30, 30)
            slope = 1 / (1 + np.exp(-margin)) - labels[batch]
            past_b += slope.sum() ** 2
            model.bias -= RATE * slope.sum() / np.sqrt(past_b)
            if not len(term):
                continue
            seen, place = np.unique(term, return_inverse=True)
            times = np.bincount(place)
            g = np.bincount(place, weights=slope[row])
            past_w[seen] += g * g
            step = RATE / np.sqrt(past_w[seen])
            moved = model.weights[seen] - step * g
            model.weights[seen] = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty[seen] * times, 0)
            for f in range(FACTORS):
                v = model.factors[term, f]
                total = np.bincount(row, weights=v, minlength=len(batch))
                g = np.bincount(place, weights=slope[row] * (total[row] - v))
                g += SHRINK * times * model.factors[seen, f]
                past_v[seen, f] += g * g
                model.factors[seen, f] -= FACTOR_RATE * g / np.sqrt(past_v[seen, f])
    return model


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "text"):
        _, bucket = term_rows(batch.column("text"))
        held, n = np.unique(bucket, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n)], ["bucket", "n"])


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on ``labels`` (doc_id, toxic) and the texts of ``docs``: about ``TRAIN_ROWS`` labelled rows.

    Null ids, labels and texts teach nothing; an id labelled twice is toxic if one
    label says so.  Without rows every text gets the same low score.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic")
    )
    share = TRAIN_ROWS / max(known.count(), 1)
    parts = 1_000_000
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < int(parts * share) + 1)
    rows = docs.where("text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        F.broadcast(chosen), "doc_id"  # bounded by TRAIN_ROWS
    ).select("doc_id", "text", "toxic")
    counts = (
        rows.mapInArrow(_bucket_counts, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= MIN_ROWS)
    )
    best = counts.orderBy(F.desc("n"), "bucket").limit(KEPT).select("bucket").toPandas()
    kept = np.sort(best["bucket"].to_numpy(np.int64))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            row, term = term_rows(batch.column("text"), kept)
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(term.astype(np.int32)))
            columns = [batch.column("doc_id"), batch.column("toxic"), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "terms"])

    sample = rows.mapInArrow(terms, "doc_id long, toxic int, terms array<int>").toArrow()  # bounded by TRAIN_ROWS
    values, begins, sizes = flat(sample.column("terms"))
    ids = sample.column("doc_id").to_numpy()
    toxic = sample.column("toxic").to_numpy().astype(float)
    order = np.lexsort((_sums(values, begins, sizes), sizes, toxic, ids))  # the order of rows must not matter
    return fit(kept, values, begins[order], sizes[order], toxic[order])


def _sums(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each row's values; the rows lie end to end."""
    found = np.zeros(len(sizes), dtype=np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        found[full] = np.add.reduceat(values, begins[full], dtype=np.int64)
    return found


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score, predicted) for every row; null and empty texts hold no term and get the bias's score."""
    shipped = docs.sparkSession.sparkContext.broadcast(
        (machine.kept, machine.bias, machine.weights, machine.factors)
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*shipped.value)
        for batch in by_bytes(batches, 1):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(machine.scores(batch.column(1)))], ["doc_id", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def training_labels(labels: DataFrame) -> DataFrame:
    """The labels outside the held-out fourth: crc32 of the id modulo 4 is not 2."""
    return labels.where(fold("doc_id", 4) != 2).select("doc_id", "toxic")
