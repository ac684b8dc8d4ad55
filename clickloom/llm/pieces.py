"""SentencePiece encoding and decoding by a Viterbi pass over a trie of distinct marked words.

Distinct words of a batch are sorted, which walks their trie depth first, and each
word starts from the forward states of the prefix it shares with the word before.

For unigram models a state is the best sum of piece scores.  In a model made by
merges (byte-pair encoding) the sum of scores does not give the model's own
pieces; there a path is allowed only if merging every two neighbours' characters
gives just these two pieces.  Exactly one such path ends at each prefix, and it is the model's encoding of
that prefix, so states are still shared by all words with that prefix.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickloom.llm.hashing import by_bytes, portions

MARK = "▁"
#: Bytes of remembered words with their ids and decoded bytes, and what a dictionary needs for each.
_REMEMBERED = 144 << 20
_EACH = 300
#: Longer words are not remembered.
_LONG = 1 << 10
_CACHED_PAIRS = 500_000


class _Follows(dict):
    """Whether merging the characters of two pieces gives just these two, by both ids in one key; worked out at first sight."""

    def __init__(self, vocabulary: "Pieces"):
        self._of = vocabulary

    def __missing__(self, key: int) -> bool:
        if len(self) >= _CACHED_PAIRS:
            self.clear()
        found = self[key] = self._of.stand(self._of.names[key >> 32], self._of.names[key & 0xFFFFFFFF])
        return found


class Pieces:
    """A vocabulary: (piece, score) by id, with ``None`` for ids that stand for no text.

    ``merges`` says whether its pieces were made by merges; if not given, the scores do:
    a model made by merges numbers its pieces in the order in which it made them, so all are whole
    numbers, which logarithms of probabilities are not.
    """

    def __init__(
        self, entries: list[tuple[str, float] | None], byte_ids: list[int], merges: bool | None = None
    ):
        self.ids = {e[0]: i for i, e in enumerate(entries) if e is not None}
        self.scores = {e[0]: e[1] for e in entries if e is not None}
        self.texts = [e[0].encode() if e is not None else b"" for e in entries]
        for byte, i in enumerate(byte_ids):
            self.texts[i] = bytes([byte])
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("words can be encoded one by one only if no piece has a mark inside")
        self.byte_ids = byte_ids
        #: Ids of pieces; -1 for what is only the end of one.
        self.endings = dict.fromkeys((p[k:] for p in self.ids for k in range(len(p))), -1) | self.ids
        self.unknown = min(self.scores.values(), default=0.0) - 10.0
        if merges is None:
            merges = all(score == int(score) for score in self.scores.values())
        self.merges = merges
        self.names = [e[0] if e is not None else "" for e in entries]
        self._follows = _Follows(self)
        self._alone: dict[int, bool] = {}
        inside = set("".join(self.ids))
        self._chunk = re.compile("\n|▁*[^▁\n]+|▁+" if "\n" not in inside else "▁*[^▁]+|▁+")
        self._words: dict[str, tuple[bytes, bytes]] = {}
        self._older: dict[str, tuple[bytes, bytes]] = {}
        self._taken = 0

    def merged(self, text: str, border: int = 0) -> list[str]:
        """What merging characters, best score first and leftmost among equals, ends with; nothing if it crosses ``border``."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            if at + 1 == border:
                return []
            border -= at + 1 < border
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stand(self, before: str, piece: str) -> bool:
        """Whether merging leaves ``piece`` just so behind ``before``, which may be empty."""
        return self.merged(before + piece, len(before)) == ([before, piece] if before else [piece])

    def _forward_merges(self, word: str, begin: list[int], last: list[int]) -> None:
        """For each prefix not yet known, where its last piece begins, and the piece's id (-1 for none).

        The first piece, from the shortest, that may stand behind the path before it is the only one.
        """
        endings, follows, alone = self.endings.get, self._follows, self._alone
        for end in range(len(begin), len(word) + 1):
            at = end - 1
            known = endings(word[at])
            while known is not None:
                if known >= 0:
                    if not at:
                        if known not in alone:
                            alone[known] = self.stand("", word[:end])
                        fits = alone[known]
                    elif last[at] >= 0:
                        fits = follows[last[at] << 32 | known]
                    else:
                        fits = self.stand(word[begin[at] : at], word[at:end])
                    if fits:
                        break
                if not at:
                    known = None
                    break
                at -= 1
                known = endings(word[at:end])  # none: nothing longer ends like this
            if known is None:  # a character that no piece holds stands alone
                begin.append(end - 1)
                last.append(-1)
            else:
                begin.append(at)
                last.append(known)

    def _forward_scores(self, word: str, begin: list[int], last: list[int], score: list[float]) -> None:
        """The same by the best sum of scores."""
        for end in range(len(begin), len(word) + 1):
            chosen, held, best = -1, -1, float("-inf")
            for at in range(end - 1, -1, -1):
                piece = word[at:end]
                known = self.endings.get(piece)
                if known is None and at < end - 1:
                    break
                if known is not None and known >= 0:
                    own = self.scores[piece]
                elif at == end - 1:
                    known, own = -1, self.unknown
                else:
                    continue
                if score[at] + own >= best:
                    chosen, held, best = at, known, score[at] + own
            begin.append(chosen)
            last.append(held)
            score.append(best)

    def _ids_of(self, word: str, begin: list[int], last: list[int]) -> list[int]:
        ids: list[int] = []
        end = len(word)
        while end:
            if last[end] >= 0:
                ids.append(last[end])
            else:
                ids.extend([self.byte_ids[b] for b in reversed(word[begin[end] : end].encode())])
            end = begin[end]
        ids.reverse()
        return ids

    def learn(self, words: Iterable[str]) -> None:
        """Encode distinct words in sorted order, each from the prefix shared with the one before."""
        previous, begin, last, score = "", [0], [-1], [0.0]
        texts = self.texts
        for word in sorted(words):
            shared = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                shared += 1
            del begin[shared + 1 :], last[shared + 1 :], score[shared + 1 :]
            if self.merges:
                self._forward_merges(word, begin, last)
            else:
                self._forward_scores(word, begin, last, score)
            ids = self._ids_of(word, begin, last)
            self._words[word] = (array("I", ids).tobytes(), b"".join([texts[i] for i in ids]))
            self._taken += 4 * len(word) + 5 * len(ids) + _EACH
            previous = word

    def code_batch(self, texts: list[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of each text as little-endian 32-bit numbers, and the bytes these ids stand for; none for null and empty texts."""
        chunks = [self._chunk.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if self._taken > _REMEMBERED // 2:  # what the next half does not use is forgotten
            self._older, self._words, self._taken = self._words, {}, 0
        words, older = self._words, self._older
        wanted = {c for cs in chunks for c in cs}
        new = []
        for chunk in wanted.difference(words):
            if chunk in older:
                words[chunk] = older[chunk]
                self._taken += 5 * len(chunk) + _EACH
            else:
                new.append(chunk)
        self.learn(new)
        for cs in chunks:
            parts = [words[c] for c in cs]
            yield b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])
        for chunk in wanted:
            if len(chunk) > _LONG:
                del words[chunk]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        return [ids for ids, _ in self.code_batch(texts)]

    def text_of(self, joined: bytes) -> str:
        """The text of the bytes that ids stand for."""
        text = joined.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text

    def decode(self, ids: Iterable[int]) -> str:
        return self.text_of(b"".join(map(self.texts.__getitem__, ids)))


def read_model(path: str | None = None) -> tuple[list[tuple[str, float] | None], list[int]]:
    """Entries and byte ids of a SentencePiece model file (the public 32k one by default)."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    entries: list[tuple[str, float] | None] = []
    for i in range(model.vocab_size()):
        silent = model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        entries.append(None if silent else (model.id_to_piece(i), model.get_score(i)))
    return entries, [model.piece_to_id(f"<0x{byte:02X}>") for byte in range(256)]


def encoded(
    docs: DataFrame, model: str | None = None, merges: bool | None = None, back: bool = False
) -> DataFrame:
    """(doc_id, text, ids, ids_crc32) for every row; null and empty texts have no ids.

    ``ids_crc32`` is that of the ids as little-endian unsigned 32-bit numbers.  With
    ``back``, ``decoded`` has the text that the ids stand for, as ``decoded`` below gives it, from the same pass.
    Rows that repeat an id, or have none, are encoded each; an empty table gives none.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(read_model(model))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(*shipped.value, merges)
        for batch in by_bytes(batches, 1):
            coded, texts = [], []
            for ids, joined in pieces.code_batch(batch.column(1).to_pylist()):
                coded.append(ids)
                if back:
                    texts.append(pieces.text_of(joined))
            offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded], dtype=np.int64)]).astype(np.int32)
            ids = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(coded))])
            lists = pa.ListArray.from_arrays(pa.array(offsets), ids)
            crcs = pa.array([zlib.crc32(c) for c in coded], pa.int64())
            columns = [batch.column(0), batch.column(1), lists, crcs]
            names = ["doc_id", "text", "ids", "ids_crc32"]
            if back:
                columns.append(pa.array(texts, pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, ids array<int>, ids_crc32 long" + (", decoded string" if back else "")
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(encode, schema)


def decoded(rows: DataFrame, model: str | None = None) -> DataFrame:
    """``rows`` (with ``ids``) and the text the ids stand for, as ``decoded``; null ids give an empty text.

    A column of that name is replaced.
    """
    rows = rows.drop("decoded")
    shipped = rows.sparkSession.sparkContext.broadcast(read_model(model))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(*shipped.value)
        for batch in portions(batches, "ids"):
            texts = [pieces.decode(i or ()) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
            )

    schema = StructType([*rows.schema.fields, StructField("decoded", StringType())])
    return rows.mapInArrow(decode, schema)
