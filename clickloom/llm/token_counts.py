"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie.  A node's failure link leads to the node of what is
left once the longest pieces at the front of its string are popped, and the
number popped on the way is stored, so one pass over a word's characters counts its
greedy longest-match pieces without building or rescanning any.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.hashing import by_bytes

#: What the public vocabulary puts before a word.
MARK = "▁"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CACHED = 500_000
#: Longer words are not remembered.
_LONG = 1 << 10


class Automaton:
    """Counts greedy longest-match pieces; a word that cannot be matched whole is one unknown token."""

    def __init__(self, pieces: Iterable[str]):
        children: list[dict[str, int]] = [{}]
        ends = [False]
        for piece in sorted(set(pieces) - {""}):
            node = 0
            for c in piece:
                following = children[node].get(c)
                if following is None:
                    following = children[node][c] = len(children)
                    children.append({})
                    ends.append(False)
                node = following
            ends[node] = True
        fail = [-1] * len(children)
        popped = [0] * len(children)
        level = [0]
        while level:  # breadth first: links of shorter strings are known
            deeper = []
            for node in level:
                for c, child in children[node].items():
                    deeper.append(child)
                    if ends[child]:
                        fail[child], popped[child] = 0, 1
                        continue
                    at, count = fail[node], popped[node]
                    while at >= 0 and c not in children[at]:
                        count += popped[at]
                        at = fail[at]
                    if at >= 0:
                        fail[child], popped[child] = children[at][c], count
            level = deeper
        self.children, self.fail, self.popped = children, fail, popped

    def count(self, word: str) -> int:
        """Pieces of ``word``, or 0 if greedy matching gets stuck."""
        children, fail, popped = self.children, self.fail, self.popped
        node = total = 0
        for c in word:
            following = children[node].get(c)
            while following is None:
                if fail[node] < 0:
                    return 0
                total += popped[node]
                node = fail[node]
                following = children[node].get(c)
            node = following
        while node:
            if fail[node] < 0:
                return 0
            total += popped[node]
            node = fail[node]
        return total


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        self._count = automaton.count

    def __missing__(self, word: str) -> int:
        found = self._count(MARK + word)
        if len(word) <= _LONG:
            if len(self) >= _CACHED:
                self.clear()
            self[word] = found
        return found


def default_pieces() -> list[str]:
    """The ordinary pieces of the public 32k vocabulary."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return [model.id_to_piece(i) for i in range(model.vocab_size()) if not any(s(i) for s in special)]


def token_counts(docs: DataFrame, pieces: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) for every row.

    Words are runs of characters other than space and tab to carriage return,
    marked in front as the vocabulary marks words; a word without a whole match counts as one
    unknown token.  Null and empty texts have no words; repeated rows are counted each.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(default_pieces() if pieces is None else list(pieces))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(Automaton(shipped.value))
        for batch in by_bytes(batches, 1):
            n_words, n_tokens, n_unknown = [], [], []
            for text in batch.column(1).to_pylist():
                found = [counts[w] for w in _WORD.findall(text)] if text else []
                unknown = found.count(0)
                n_words.append(len(found))
                n_tokens.append(sum(found) + unknown)
                n_unknown.append(unknown)
            columns = [pa.array(x, pa.int64()) for x in (n_words, n_tokens, n_unknown)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.col("doc_id"), F.col("text").cast("string")).mapInArrow(
        count, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long"
    )
