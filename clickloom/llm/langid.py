"""Language identification: script ranges, per-word scores, and Viterbi with a switching penalty.

A word's script leaves the languages written in it as candidates.  Each candidate
scores the word by its character n-grams (1 to 4, hashed), and Viterbi over the
words of a whole text finds the cheapest labelling, where every change of
language costs a fixed penalty.  The labelling gives spans; a text's language is that
of most of its letters.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fold, written
from clickloom.llm.hashing import by_bytes, positions

#: Model bound: different texts to learn from for each language (expected).
TRAIN_DOCS = 4000
BUCKETS = 1 << 16
ORDERS = 4
SMOOTHING = 0.5
#: Nats for a change of language; share of its letters that makes a script one of a language.
SWITCH = 8.0
SCRIPT_SHARE = 0.01
#: Scores held at once in a task (words times languages).
CELLS = 1 << 22
#: Words of about so many characters are cut into n-grams at a time.
POINTS = 1 << 16

#: First code points of stretches of one script, by Unicode block.
SCRIPT_STARTS = (
    (0x0000, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"),
    (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x1380, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"), (0x30000, "other"),
)
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})
_STARTS = np.array([start for start, _ in SCRIPT_STARTS])
_SCRIPT_AT = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])
#: Up to so many languages the scores are laid out as a table in a task.
TABLE = 256


def _marks() -> str:
    """Combining marks, vowel signs among them, as ranges for a pattern."""
    held = [c for c in (*range(0x300, 0x20000), *range(0xE0100, 0xE01F0)) if unicodedata.category(chr(c)) in ("Mn", "Mc")]
    first = [c for c, before in zip(held, [-2, *held]) if c != before + 1]
    last = [c for c, after in zip(held, [*held[1:], -2]) if c + 1 != after]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(first, last))


#: Letters, and letters with the marks that go with them.
_LETTERS = re.compile(r"[^\W\d_]+")
_WORD = re.compile(rf"[^\W\d_]+(?:[{_marks()}]+[^\W\d_]*)*")


def scripts_of(points: np.ndarray) -> np.ndarray:
    return _SCRIPT_AT[np.searchsorted(_STARTS, points, side="right") - 1]


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, with the marks on them."""
    text = (text or "").lower()
    try:
        text.encode("latin-1")  # holds no marks
        words = _LETTERS.findall(text)
    except UnicodeEncodeError:
        words = _WORD.findall(text)
    return [w for w in words if w.isalpha() or any(c.isalpha() for c in w)]


def word_lists(texts: pa.Array) -> list[list[str]]:
    """The words of each text."""
    return [words_of(text) for text in texts.to_pylist()]


def stretches(words: list[str]) -> Iterator[tuple[int, int]]:
    """Ends of stretches of ``words`` that hold about ``POINTS`` characters together, one word at least."""
    ends = np.cumsum([len(w) for w in words])
    begin = done = 0
    while begin < len(words):
        stop = max(int(np.searchsorted(ends, done + POINTS, side="right")), begin + 1)
        yield begin, stop
        begin, done = stop, int(ends[stop - 1])


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of its word and bucket of every n-gram; and each word's script."""
    sizes = np.array([len(w) for w in words], dtype=np.int64) + 2
    points = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    room = np.repeat(starts + sizes, sizes) - np.arange(len(points))
    owners, buckets = [], []
    state = np.zeros(len(points), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for n in range(ORDERS):
            upto = len(points) - n
            state = (state[:upto] * np.uint64(1_000_003)) ^ points[n:].astype(np.uint64)
            inside = room[:upto] > n
            spread = (state[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            owners.append(owner[:upto][inside])
            buckets.append((spread >> np.uint64(48)).astype(np.int64) % BUCKETS)
    return np.concatenate(owners), np.concatenate(buckets), scripts_of(points[starts + 1])


@dataclass
class Model:
    """Log-probabilities over ORDERS: what a bucket never seen has in each language, and what each one seen adds.

    ``starts`` says where a bucket's entries begin in ``of`` (languages) and ``gains``.
    """

    languages: list[str]
    starts: np.ndarray
    of: np.ndarray
    gains: np.ndarray
    unseen: np.ndarray
    written_in: np.ndarray  # scripts x languages, whether a candidate

    def parts(self) -> tuple:
        return self.languages, self.starts, self.of, self.gains, self.unseen, self.written_in

    def _table(self) -> np.ndarray | None:
        if len(self.languages) > TABLE:
            return None
        if not hasattr(self, "_laid_out"):
            self._laid_out = np.tile(self.unseen, (BUCKETS, 1))
            self._laid_out[np.repeat(np.arange(BUCKETS), np.diff(self.starts)), self.of] += self.gains
        return self._laid_out

    def _sums(self, owner: np.ndarray, bucket: np.ndarray, words: int) -> np.ndarray:
        """Sum of the scores of each word's n-grams, which come in order of their words."""
        table, count = self._table(), len(self.languages)
        found = np.zeros((words, count), dtype=np.float32)
        for begin in range(0, len(owner), most := max(1, CELLS // count)):  # a word may have any number of n-grams
            own, seen = owner[begin : begin + most], bucket[begin : begin + most]
            heads = np.flatnonzero(np.diff(own, prepend=-1))
            if table is not None:
                found[own[heads]] += np.add.reduceat(table[seen], heads, axis=0)
                continue
            row, nth = positions(self.starts[seen + 1] - self.starts[seen])
            at = self.starts[seen][row] + nth
            first, last = int(own[0]), int(own[-1])
            cell = (own[row] - first) * count + self.of[at]
            added = np.bincount(cell, weights=self.gains[at], minlength=(last - first + 1) * count)
            times = np.bincount(own - first, minlength=last - first + 1)
            found[first : last + 1] += added.reshape(-1, count) + times[:, None] * self.unseen
        return found

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Score of each word in each language, ruled-out languages far below the rest; and whether it has a candidate."""
        found = np.empty((len(words), len(self.languages)), dtype=np.float32)
        script = np.empty(len(words), dtype=np.int64)
        for a, b in stretches(words):
            owner, bucket, script[a:b] = ngrams(words[a:b])
            order = np.argsort(owner, kind="stable")
            found[a:b] = self._sums(owner[order], bucket[order], b - a)
        candidates = self.written_in[script]
        known = candidates.any(axis=1, keepdims=True)
        scores = np.where(known, np.where(candidates, found, found.min() - 100.0), 0.0).astype(np.float32)
        return scores, known[:, 0]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, bucket, count) of the n-grams of words; scripts of letters as buckets below 0."""
    for batch in by_bytes(batches, "text"):
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        found: dict[str, Counter[str]] = {}
        for lang, text in zip(langs, batch.column("text").to_pylist()):
            found.setdefault(lang, Counter()).update(words_of(text))
        for lang, times_of in found.items():
            if not times_of:
                continue
            distinct, times = list(times_of), np.array(list(times_of.values()))
            counts, letters = np.zeros(BUCKETS), np.zeros(len(SCRIPTS))
            for a, b in stretches(distinct):
                owner, bucket, script = ngrams(distinct[a:b])
                counts += np.bincount(bucket, weights=times[a:b][owner], minlength=BUCKETS)
                long = np.array([len(w) for w in distinct[a:b]])
                letters += np.bincount(script, weights=times[a:b] * long, minlength=len(SCRIPTS))
            keys = np.concatenate([np.flatnonzero(counts), -1 - np.flatnonzero(letters)])
            n = np.concatenate([counts[counts > 0], letters[letters > 0]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys)), pa.array(keys), pa.array(n)], ["lang", "bucket", "n"]
            )


def train(labelled: DataFrame) -> Model:
    """Learn from (text, lang); null text or lang teaches nothing.

    About ``TRAIN_DOCS`` different texts of each language are used, chosen by a hash, or all if it has no more;
    copies of a text count once.
    """
    known = labelled.where("lang is not null and text is not null").select(
        F.col("lang").cast("string").alias("lang"), "text"
    )
    sizes = written(known.groupBy("lang").agg(F.count_distinct(F.xxhash64("text")).alias("texts")), "languages")
    languages = sorted(r["lang"] for r in sizes.select("lang").collect())  # the model names every one
    if not languages:
        none = np.zeros(0, np.int64)
        return Model([], np.zeros(BUCKETS + 1, np.int64), none, none.astype(np.float32), none.astype(np.float32), np.zeros((len(SCRIPTS), 0), bool))
    parts = 1_000_000
    share = F.ceil(F.lit(parts * TRAIN_DOCS) / F.col("texts"))
    chosen = (
        known.join(F.broadcast(sizes), "lang")  # a row for each language
        .where(F.pmod(F.xxhash64("text"), F.lit(parts)) < share)
        .select("lang", "text")
        .distinct()
    )
    numbers = known.sparkSession.createDataFrame(list(enumerate(languages)), "number int, lang string")
    rows = (
        chosen.mapInArrow(_counted, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .join(F.broadcast(numbers), "lang")
        .select("number", F.col("bucket").cast("int").alias("bucket"), "n")
        .toArrow()
    )  # at most BUCKETS rows for each language
    column, bucket, n = (rows.column(c).to_numpy() for c in ("number", "bucket", "n"))
    grams = bucket >= 0
    letters = np.zeros((len(SCRIPTS), len(languages)))
    letters[-1 - bucket[~grams], column[~grams]] = n[~grams]
    column, bucket, n = column[grams], bucket[grams], n[grams].astype(np.float64)
    order = np.lexsort((column, bucket))
    column, bucket, n = column[order], bucket[order], n[order]
    total = np.bincount(column, weights=n, minlength=len(languages)) + SMOOTHING * BUCKETS
    unseen = (np.log(SMOOTHING / total) / ORDERS).astype(np.float32)
    gains = (np.log((n + SMOOTHING) / SMOOTHING) / ORDERS).astype(np.float32)
    starts = np.searchsorted(bucket, np.arange(BUCKETS + 1))
    written_in = (letters >= SCRIPT_SHARE * letters.sum(axis=0)) & (letters > 0)
    return Model(languages, starts, column.astype(np.int32), gains, unseen, written_in)


def viterbi(scores: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Label of every word of texts laid end to end; all texts advance together, word by word."""
    order = np.argsort(-sizes, kind="stable")
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[order]
    lengths = sizes[order]
    count = scores.shape[1]
    back = np.empty((len(words), count), dtype=np.int16 if count < 1 << 15 else np.int32)
    best = np.zeros((len(sizes), count), dtype=np.float32)
    own = np.arange(count)
    active = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
    for t, live in enumerate(active):
        at = starts[:live] + t
        now = best[:live]
        if t:
            top = now.argmax(axis=1)
            floor = now[np.arange(live), top] - SWITCH
            stays = now >= floor[:, None]
            back[at] = np.where(stays, own, top[:, None])
            now = np.where(stays, now, floor[:, None])
        now = now + scores[words[at]]
        best[:live] = now - now.max(axis=1, keepdims=True)
    labels = np.empty(len(words), dtype=np.int64)
    current = best.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        live = active[t]
        at = starts[:live] + t
        labels[at] = current[:live]
        if t:
            current[:live] = back[at, current[:live]]
    return labels


class Judge:
    """Applies a model to batches of texts."""

    def __init__(self, model: Model):
        self.model = model

    def spans(self, texts: pa.Array) -> Iterator[list[tuple[int, int, int, int, int]]]:
        """Per text: (language, first word, words, letters, letters of words with a candidate) of each span."""
        languages = max(1, len(self.model.languages))
        group: list[list[str]] = []
        size = 0
        for words in map(words_of, texts.to_pylist()):
            if group and (size + len(words)) * languages > CELLS:
                yield from self._spans(group)
                group, size = [], 0
            group.append(words)
            size += len(words)
        if group:
            yield from self._spans(group)

    def _spans(self, lists: list[list[str]]) -> Iterator[list[tuple[int, int, int, int, int]]]:
        numbers: dict[str, int] = {}
        flat = np.array([numbers.setdefault(w, len(numbers)) for ws in lists for w in ws], dtype=np.int64)
        sizes = np.array([len(ws) for ws in lists], dtype=np.int64)
        if not len(flat) or not self.model.languages:
            yield from ([] for _ in lists)
            return
        distinct = list(numbers)
        scores, known = self.model.of_words(distinct)
        labels = viterbi(scores, flat, sizes)
        lengths = np.array([len(w) for w in distinct])
        letters, voting = np.cumsum(lengths[flat]), np.cumsum((lengths * known)[flat])
        ends = np.cumsum(sizes)
        changes = np.flatnonzero(np.diff(labels)) + 1
        borders = np.unique(np.concatenate([changes, ends, [0]]))
        first = np.searchsorted(borders, ends - sizes)
        last = np.searchsorted(borders, ends)
        upto, votes = np.concatenate([[0], letters]), np.concatenate([[0], voting])
        for begin, a, b in zip(ends - sizes, first, last):
            edges = borders[a : b + 1]
            yield [
                (int(labels[x]), int(x - begin), int(y - x), int(upto[y] - upto[x]), int(votes[y] - votes[x]))
                for x, y in zip(edges[:-1], edges[1:])
            ]

    def verdict(self, spans: list[tuple[int, int, int, int, int]]) -> tuple[str, float]:
        """Language of most letters and its share of all; ties go to the first in alphabetical order.

        Words in a script that no language is written in have no vote, but count in the whole.
        """
        if not spans:
            return "und", 0.0
        share = np.bincount([s[0] for s in spans], weights=[s[4] for s in spans])
        return self.model.languages[int(share.argmax())], float(share.max() / sum(s[3] for s in spans))


_SPAN = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))


def identified(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score, spans) for every row; spans count words from 0.

    The whole text is read and nothing else.  Null texts and texts without a
    letter, or any text if no language was learned, are ``und`` with score 0 and no spans.
    A text wholly in scripts that no language is written in has score 0 as well.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model.parts())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(Model(*shipped.value))
        for batch in by_bytes(batches, 1):
            found = list(judge.spans(batch.column(1)))
            verdicts = [judge.verdict(s) for s in found]
            names = judge.model.languages
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([v[0] for v in verdicts], pa.string()),
                    pa.array([v[1] for v in verdicts], pa.float64()),
                    pa.array(
                        [[{"lang": names[s[0]], "first": s[1], "words": s[2]} for s in f] for f in found], _SPAN
                    ),
                ],
                [key, "lang_pred", "score", "spans"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        judge,
        f"`{key}` {kind}, lang_pred string, score double, spans array<struct<lang:string,first:int,words:int>>",
    )


def keep_identified(docs: DataFrame, model: Model, least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` in which one language holds at least ``least`` of the letters.

    Null texts and texts without a letter go; repeated rows are judged alike, and all columns stay.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model.parts())

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(Model(*shipped.value))
        for batch in by_bytes(batches, "text"):
            verdicts = (judge.verdict(s) for s in judge.spans(batch.column("text")))
            yield batch.filter(pa.array([lang != "und" and score >= least for lang, score in verdicts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """The labelled rows outside the held-out fifth: crc32 of the id modulo 5 is not 0."""
    return docs.where(fold("doc_id", 5) != 0).select("text", "lang")
