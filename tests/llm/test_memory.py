"""What one worker process holds, and for how long."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from clickloom.llm import byte_pairs, hashing, langid, ngram_join, substring


def test_passages_are_hashed_a_bounded_number_at_a_time():
    """A batch of long texts goes through in portions, and every anchor and window comes out."""
    rows, words = 40, 30_000
    hashes = np.random.default_rng(3).integers(-(2**62), 2**62, rows * words)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * words), pa.array(hashes))
    whole = pa.array([[{"a": 0, "b": words}]] * rows, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(rows)), pa.array([0] * rows), lists, whole], ["doc_id", "key", "hashes", "stretches"]
    )
    windows = [b.num_rows for b in substring._windows([batch])]
    assert sum(windows) == rows * (words - substring.WINDOW + 1)
    assert max(windows) <= 1 << 18
    covered = np.isin(np.arange(words - substring.WINDOW + substring.PERIOD) % substring.PERIOD, substring.COVER).sum()
    assert sum(b.num_rows for b in substring._anchors([batch])) == rows * covered


def test_a_worker_makes_a_vocabulary_once():
    """Tasks that follow each other in a process share it, what is remembered included; another vocabulary is another."""
    lines = b"".join(b"%s %d\n" % (byte_pairs.base64.b64encode(bytes([b])), b) for b in range(256))
    more = lines + b"%s 256\n" % byte_pairs.base64.b64encode(b"ab")
    one = byte_pairs._kept(lines, r"\S+|\s+", ())
    assert one is byte_pairs._kept(bytes(bytearray(lines)), r"\S+|\s+", ())
    assert one.encode(["ab ab"]) == one.encode(["ab ab"]) == [np.array([97, 98, 32, 97, 98], "<u4").tobytes()]
    other = byte_pairs._kept(more, r"\S+|\s+", ())
    assert other.encode(["ab ab"]) == [np.array([256, 32, 256], "<u4").tobytes()]


def test_a_small_tile_costs_little():
    """The product is as wide as the shingles its documents share, not as wide as a large tile's."""
    sets = [list(range(100)), list(range(5, 105)), list(range(1000, 1100))]
    tile = pa.table({"rep": [1, 2, 3], "side": pa.array([0, 0, 0], pa.int32()), "shingles": pa.array(sets, pa.list_(pa.int64()))})
    tracemalloc.start()
    links = ngram_join._tile_links(tile)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert links.to_pydict() == {"u": [2], "v": [1]}
    assert peak < 1 << 20


def _peak(run):
    """What ``run`` returns, and the most bytes it held at once."""
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_language_id_cuts_a_bounded_number_of_ngrams_at_a_time(monkeypatch):
    """Any number of different words is scored and counted in stretches, with what all at once would give."""
    rng = np.random.default_rng(5)
    words = ["".join(map(chr, row)) for row in rng.integers(97, 123, (50_000, 10))] + ["x" * (1 << 17)]
    seen = np.flatnonzero(rng.random(langid.BUCKETS) < 0.5)
    starts = np.searchsorted(seen, np.arange(langid.BUCKETS + 1))
    latin = np.array([[s == "latin"] * 2 for s in langid.SCRIPTS])
    gains = rng.random(len(seen)).astype(np.float32)
    model = langid.Model(["a", "b"], starts, np.arange(len(seen)) % 2, gains, np.float32([-1, -1]), latin)
    texts = [" ".join(words[:30_000]), None, " ".join(words[20_000:]), "\u4e00"]
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": ["a", "a", "b", "b"]})

    def counted():
        rows = pa.Table.from_batches(langid._counted([batch])).to_pylist()
        return sorted((r["lang"], r["bucket"], r["n"]) for r in rows)

    (scores, known), peak = _peak(lambda: model.of_words(words))
    assert peak < 48 << 20
    peak = _peak(lambda: list(langid._counted([batch])))[1]
    assert peak < 64 << 20
    counts = counted()
    assert sum(n for lang, bucket, n in counts if bucket < 0) == 600_000 + (1 << 17) + 1
    monkeypatch.setattr(langid, "POINTS", 1 << 40)
    whole, whole_known = model.of_words(words)
    assert np.allclose(scores, whole, rtol=1e-5) and (known == whole_known).all()
    assert counts == counted()


def test_memory_is_given_back_after_the_last_portion(monkeypatch):
    """Once for a task, when its rows are through."""
    calls = []
    monkeypatch.setattr(hashing, "give_back", lambda: calls.append(len(seen)))
    seen: list[str] = []
    batches = [pa.RecordBatch.from_pydict({"text": texts}) for texts in (["a", "bb", None], ["ccc"])]
    for portion in hashing.by_bytes(batches, "text", 2):
        seen += portion.column("text").to_pylist()
    assert seen == ["a", "bb", None, "ccc"] and calls == [4]
    monkeypatch.undo()
    hashing.give_back()
