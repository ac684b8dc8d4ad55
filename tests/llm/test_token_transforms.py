"""Byte-pair coding, fill-in-middle and the filter audit against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from array import array
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import byte_pairs, filter_audit, middle

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def ranks():
    with open(byte_pairs.default_vocabulary(), "rb") as file:
        return byte_pairs.read_ranks(file.read())


@pytest.fixture(scope="module")
def reference(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding(
        "own", pat_str=byte_pairs.default_pattern(), mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


def packed(ids) -> bytes:
    return array("I", ids).tobytes()


def test_byte_pairs_equal_the_library(docs, no_docs, reference):
    coded = byte_pairs.coded(docs)
    got = sorted((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in coded.collect())
    want = []
    for r in docs.collect():
        ids = reference(r.text or "")
        want.append((r.doc_id, len(ids), packed(ids), (r.text or "").encode()))
    assert got == sorted(want)
    assert coded.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert byte_pairs.coded(no_docs).count() == 0
    for r in coded.select("ids", byte_pairs.id_array(coded["ids"]).alias("numbers")).collect():
        assert packed(r.numbers) == bytes(r.ids)


def test_byte_pairs_on_random_text(ranks, reference):
    pairs = byte_pairs.BytePairs(ranks, byte_pairs.default_pattern(), byte_pairs.library_stand_ins())
    rng = random.Random(3)
    letters = "abc \n\t'sdon're  aaaabbbé漢🙂12 \x1c\x85\U000323af\U00016ea0<|endoftext|>"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, "".join(rng.choices("aeionst", k=70_000)), None, ""]
    for text, ids in zip(texts, pairs.encode(texts)):
        assert ids == packed(reference(text or "")), text
        assert pairs.decode(np.frombuffer(ids, "<u4").tolist()) == (text or "").encode()


def test_every_character_is_classed_as_the_library_does(ranks, reference):
    pairs = byte_pairs.BytePairs(ranks, byte_pairs.default_pattern(), byte_pairs.library_stand_ins())
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for begin in range(0, len(every), 1 << 16):
        texts = [f"a{c}a 1{c}1 !{c}! {c}\n  {c}{c}  x" for c in every[begin : begin + (1 << 16) : 7]]
        assert [packed(reference(t)) for t in texts] == pairs.encode(texts)


def naive(ranks, piece: bytes) -> list[int]:
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while True:
        found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_ranks_in_any_order():
    """A merge may make room for one of lower rank, which then comes first."""
    rng = random.Random(5)
    for _ in range(60):
        tokens = {"".join(rng.choices("abc", k=rng.randint(2, 5))).encode() for _ in range(25)}
        order = [bytes([b]) for b in range(256)] + sorted(tokens)
        rng.shuffle(order)
        ranks = {token: rank for rank, token in enumerate(order)}
        pairs = byte_pairs.BytePairs(ranks, r"[^ ]+| ")
        pieces = ["".join(rng.choices("abc", k=rng.randint(1, 40))).encode() for _ in range(40)]
        assert pairs.merged(pieces) == [packed(naive(ranks, p)) for p in pieces]


def test_memory_is_given_back(ranks, reference, monkeypatch):
    monkeypatch.setattr(byte_pairs, "_REMEMBERED", 50_000)
    pairs = byte_pairs.BytePairs(ranks, byte_pairs.default_pattern())
    rng = random.Random(8)
    for _ in range(30):
        texts = [" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(60)) for _ in range(4)] + ["x" * 3000]
        assert pairs.encode(texts) == [packed(reference(t)) for t in texts]
        assert len(pairs._runs) + len(pairs._older_runs) < 900 and "x" * 3000 not in pairs._runs
    with pytest.raises(ValueError):
        byte_pairs.BytePairs({b"a": 0}, "a")


def cuts(doc_id, text):
    """The contract of the transformation, line by line."""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 50:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def lined(seed: int, units: int, most: int) -> str:
    rng = random.Random(seed)
    return "".join("é" * rng.randint(0, most) + "\n" for _ in range(units))


def test_fill_in_middle(spark, docs, no_docs):
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    texts += [
        (None, "a\nb\nc"), (100, "one <P> two\nthree"), (101, "x<M>"), (102, "\n"), (103, "\n" * 70_000), (104, "last line\nopen"),
        (105, lined(1, 3000, 60)), (106, lined(2, 90_000, 3)), (107, "y" * 140_000), (108, "y" * 65_535 + "\n" + "z" * 65_535 + "\n"),
        (109, "y" * 65_535 + "\n"), (110, "y" * 65_536), (111, "<" * 9 + "P>S>\n<P\n>"),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns(
        {"output": F.lit("x"), "h1": F.lit(1)}  # names of the operator's own
    )
    rows = middle.transformed(df)
    rows = rows.withColumn("back", middle.restored(rows["output"], rows["form"]))
    got = sorted((tuple(r) for r in rows.collect()), key=repr)
    assert got == sorted(((d, *cuts(d, t or ""), t or "") for d, t in texts), key=repr)
    assert middle.transformed(no_docs).count() == 0
    assert {r[0] for r in middle.transformed(df, fim_rate=0).select("form").distinct().collect()} == {"plain"}


def test_containers_select():
    rng = np.random.default_rng(4)
    cases = {
        middle.ArrayContainer: np.sort(rng.choice(65_536, 900, replace=False)),
        middle.BitmapContainer: np.sort(rng.choice(65_536, 30_000, replace=False)),
        middle.RunContainer: np.concatenate([np.arange(5, 9000), np.arange(9500, 30_000), [65_535]]),
    }
    for kind, numbers in cases.items():
        held = middle.container(numbers)
        assert type(held) is kind
        assert [held.select(k) for k in range(len(numbers))] == numbers.tolist()


def test_boundaries_of_every_kind():
    for text in ("", "\n", "a", "a\n", lined(3, 70_000, 2), lined(4, 900, 900), "\n" * 200_000 + "end", "b" * 65_536 + "\n"):
        edges = middle.Boundaries(text)
        want = [0]
        for unit in re.findall(r"[^\n]*\n|[^\n]+", text):
            want.append(want[-1] + len(unit))
        assert len(edges) == len(want)
        step = max(1, len(want) // 500)
        assert [edges.select(k) for k in range(0, len(want), step)] == want[::step]
        assert edges.select(len(want) - 1) == len(text)


def audited(rows, labels):
    """Every step of every order, document by document; rows are (doc_id, text, lang)."""
    failing = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in text) > 3 * len(text) else set()
        fails |= {"D"} if any(c in "#$%&*|" for c in text) else set()
        if doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows):
            fails |= {"E"}
        failing.append((lang or "", fails, (doc_id, "quality") in labels, (doc_id, "toxic") in labels))
    found, shapley = [], {}
    for part in {f[0] for f in failing}:
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                own = [x for x in failing if x[0] == part]
                here = [x for x in own if not x[1] & set(order[: step - 1])]
                out = [x for x in here if f in x[1]]
                found.append([
                    part, order, step, len(here) - len(out), len(out),
                    sum(f in x[1] for x in own) - len(out), sum(x[1] == {f} for x in own),
                    sum(x[2] for x in out), sum(x[3] for x in out),
                ])
                shapley[part, f] = shapley.get((part, f), 0) + len(out)
    return sorted((*x, shapley[x[0], x[1][x[2] - 1]]) for x in found)


@pytest.mark.parametrize("hot", [256, 2])
def test_filter_audit(spark, prose, docs, no_docs, monkeypatch, hot):
    monkeypatch.setattr(filter_audit, "HOT", hot)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    rows += [(100 + k, "the same text again " * 60, "en") for k in range(40)]
    rows += [(200, prose(30, 300), "de"), (201, prose(30, 300), "fr"), (201, prose(31, 300), "fr"), (None, prose(30, 300), "fr")]
    rows += [(300, prose(32, 250).upper() + " #", None), (301, None, None), (None, None, "de"), (None, None, "de")]
    known = [(7, 1, 1), (8, 0, 1), (8, 1, 0), (9, None, 1), (None, 1, 1), (105, 1, 0), (999, 1, 1), (201, 1, 1)]
    labels = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, bits int, part string")
    good = {(d, "quality") for d, q, _ in known if q == 1 and d is not None}
    toxic = {(d, "toxic") for d, _, t in known if t == 1 and d is not None}
    got = sorted(tuple(r) for r in filter_audit.audit(table, labels).collect())
    assert got == audited(rows, good | toxic)
    assert filter_audit.audit(no_docs, labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).count() > 0
