"""Operators on texts against plain Python on awkward rows."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.llm import common, hashing, langid, ngram_join, packing, pieces, quality, substring, token_counts, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_quality_measures(docs, no_docs):
    got = by_id(quality.judged(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for doc_id, text in texts(docs):
        words = WORD.findall(text or "")
        windows = {}
        for k in range(len(words) - 7):
            windows.setdefault(tuple(words[k : k + 8]), []).append(k)
        covered = {k + j for ks in windows.values() if len(ks) > 1 for k in ks for j in range(8)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        assert got[doc_id] == (
            len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed,
        ), doc_id
    assert quality.judged(no_docs).count() == 0


def test_quality_fences_follow_the_group(spark):
    """A third of one source is symbols: there they are ordinary, elsewhere they are not."""
    plain = " ".join(f"word{k}" for k in range(40))
    marked = " ".join(f"word{k}#" for k in range(40))
    rows = [(k, plain if k % 2 else marked, "en", "forum") for k in range(600)]
    rows += [(1000 + k, plain, "en", "news") for k in range(300)] + [(2000, marked, "en", "news")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = by_id(quality.judged(df), "kept")
    assert kept[0] == kept[1] == kept[1000] == (True,) and kept[2000] == (False,)
    assert quality.keep_good(df).columns == df.columns and quality.keep_good(df).count() == 900


def test_substring_removal(docs, no_docs):
    got = by_id(substring.removed(docs), "n_words", "n_removed", "kept")
    rows = sorted({(d, t or "") for d, t in texts(docs)})
    first = {}
    for doc_id, text in rows:
        words = WORD.findall(text)
        for k in range(len(words) - 19):
            first.setdefault(tuple(words[k : k + 20]), (doc_id, k))
    for doc_id, text in rows:
        words = WORD.findall(text)
        gone = set()
        for k in range(len(words) - 19):
            if first[tuple(words[k : k + 20])] != (doc_id, k):
                gone.update(range(k, k + 20))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        assert got[doc_id] == (len(words), len(gone), kept), doc_id
    assert got[13][1] == 30 and got[8][1] == 6000 and got[14][1] > 150
    assert substring.removed(no_docs).count() == 0
    cut = substring.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    changed = {r.doc_id: r for r in cut.collect()}
    assert changed[8].text == "" and changed[8].n_chars == 0 and changed[3].text == " \n\t " and changed[1].text is None
    assert changed[9].n_words == -1


def test_substring_removal_on_many_alignments(spark, prose):
    """Passages of 20 to 33 words at every distance modulo the period."""
    rng = random.Random(5)
    rows, serial = [], 0
    for shift in range(13):
        passage = prose(100 + shift, 20 + shift)
        for lead in (3, 3 + shift):
            rows.append((serial, f"{prose(200 + serial, lead)} {passage} {prose(300 + serial, rng.randint(5, 40))}"))
            serial += 1
    got = by_id(substring.removed(spark.createDataFrame(rows, "doc_id long, text string")), "n_removed")
    assert [got[k][0] for k in range(serial)] == [n for s in range(13) for n in (0, 20 + s)]


def jaccard_components(rows):
    sets = {}
    for doc_id, text in rows:
        words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[doc_id] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    label = {d: d for d in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {d: low if x == high else x for d, x in label.items()}
    return {d: (len(sets[d]), label[d]) for d in sets}


def test_words_are_cut_and_hashed_in_tasks(prose):
    """By the contract's rule, whatever the batch: slices, nulls, other spaces, long words."""
    own = ["A b\tC\x0bd\x0c\x0d\ne", "a B c D E", "", " ", None, "\x1cx\x85y\xa0z\u2003", "É漢字É é漢字É", " a", "b ", "ab", "Ab", "aB" * 300, "ab" * 300]
    own += ["x" * k for k in range(1, 140)] + [prose(70, 500)]
    hashes = {}
    for begin, end in ((0, len(own)), (3, 9), (4, 5), (2, 4), (0, 0)):
        for kind in (pa.string(), pa.large_string()):
            texts = pa.array(own, kind)[begin:end]
            values, begins, sizes = hashing.lower_word_hashes(texts)
            for text, at, size in zip(texts.to_pylist(), begins, sizes, strict=True):
                cut = WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
                assert size == len(cut)
                for word, value in zip(cut, values[at : at + size], strict=True):
                    assert hashes.setdefault(word, value) == value
    assert len(set(hashes.values())) == len(hashes) > 400


def test_ngram_join(docs, no_docs):
    got = by_id(ngram_join.linked_components(docs), "n_shingles", "component_id")
    assert got == jaccard_components(texts(docs))
    assert got[11][1] == 9 and got[5][1] == 4 and got[2] == (0, 2)
    assert ngram_join.linked_components(no_docs).count() == 0
    left = {r.doc_id for r in ngram_join.one_of_each(docs).collect()}
    assert {4, 7, 9, 1, 2, 3} <= left and not {5, 8, 10, 11} & left


@pytest.mark.parametrize(("few", "most_last", "together"), [(1, 1 << 20, 1), (32, 1 << 20, 1 << 20), (1, 5, 1 << 20)])
def test_ngram_join_on_families(spark, prose, monkeypatch, few, most_last, together):
    """Copies with few to many edits around several bases, all with one line in common.

    Also with most columns tied, with few of the common columns last, with small tiles, and sizes ranked in many groups.
    """
    monkeypatch.setattr(ngram_join, "MOST_LAST", most_last)
    monkeypatch.setattr(ngram_join, "RANKED_TOGETHER", together)
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "MANY", 4 * few)
    monkeypatch.setattr(ngram_join, "TILE", 3000)
    rng = random.Random(9)
    line = prose(50, 12)
    rows = []
    for base in range(4):
        words = prose(60 + base, 90).split()
        for copy in range(15):
            own = list(words)
            for _ in range(copy // 3):
                own[rng.randrange(len(own))] = f"edit{rng.random()}"
            rows.append((len(rows), f"{line} {' '.join(own[: rng.randint(70, 90)])}"))
    rows += [(100 + k, f"{line} {prose(90 + k, 40)}") for k in range(30)]
    got = by_id(ngram_join.linked_components(spark.createDataFrame(rows, "doc_id long, text string")), "n_shingles", "component_id")
    assert got == jaccard_components(rows)
    assert 4 < len({c for _, c in got.values()}) < 90


def test_packing(docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.packed_documents(docs, with_ids=True).collect()
    place = {}
    for r in rows:
        assert r.length == len(r.ids) <= 1024 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        place.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in place.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 1024
    for doc_id, text in dict(texts(docs)).items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        own = {r.piece: r for r in rows if r.doc_id == doc_id}
        assert [i for k in sorted(own) for i in own[k].ids] == ids
        assert [own[k].start for k in sorted(own)] == [len(ids) - sum(own[j].length for j in own if j >= k) for k in sorted(own)]
        assert all(own[k].length == 1024 for k in own if k)
    assert packing.packed_documents(no_docs).count() == 0


def test_packing_in_many_rank_groups(spark, monkeypatch):
    """Pieces of few lengths, some rows twice, ranked in dozens of groups."""
    monkeypatch.setattr(packing, "_RANKED_TOGETHER", 7)
    rng = random.Random(31)
    rows = [(k, 0, rng.choice([1, 30, 31, 40, 99, 100])) for k in range(400)]
    rows += rows[:25]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, length long")
    place = {}
    for r in packing.packed(cut, 100).collect():
        place.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(n for parts in place.values() for _, n in parts) == sorted(n for *_, n in rows)
    for parts in place.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 100


def test_gaps_are_filled_exactly_by_up_to_three():
    plan = dict(packing.plan({700: 4, 324: 1, 200: 1, 124: 1, 114: 1, 110: 1, 100: 1, 99: 1}))
    assert plan[700, 324] == plan[700, 200, 124] == plan[700, 114, 110, 100] == 1  # and 99 beside the last
    assert plan[700, 99] == 1
    sums = packing.Sums(np.array([0, 0, 0, 2, 1, 1] + [0] * 9))  # two of 3, one of 4, one of 5
    assert [sums.making(n) for n in (3, 6, 7, 9, 10, 11, 13)] == [(3,), (3, 3), (4, 3), (5, 4), (4, 3, 3), (5, 3, 3), None]


def test_tokenizer_on_odd_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    with open(packing.default_vocabulary(), "rb") as file:
        encode = packing.encoder(file.read())
    rng = random.Random(1)
    letters = [*"ab 'sdl9 \n\t\r\x1c\x85é漢!?", "<|endoftext|>", "  ", "'ve", " \n "]
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 25)))
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_plan_places_everything():
    rng = random.Random(3)
    for capacity in (16, 1024):
        for _ in range(20):
            counts = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(0, 40))}
            patterns = packing.plan(counts, capacity)
            placed = {}
            for pattern, times in patterns:
                assert sum(pattern) <= capacity and times > 0
                for length in pattern:
                    placed[length] = placed.get(length, 0) + times
            assert placed == counts
    assert sum(n for _, n in packing.plan({700: 3, 324: 3, 500: 2, 24: 2, 400: 1, 600: 1, 1024: 5})) == 10


def test_token_counts(docs, no_docs):
    vocabulary = set(token_counts.default_pieces())
    longest = max(map(len, vocabulary))

    def brute(word):
        n = at = 0
        while at < len(word):
            step = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in vocabulary), 0)
            if not step:
                return 0
            at, n = at + step, n + 1
        return n

    got = by_id(token_counts.token_counts(docs), "n_words", "n_tokens", "n_unknown")
    for doc_id, text in texts(docs):
        counts = [brute("▁" + w) for w in WORD.findall(text or "")]
        assert got[doc_id] == (len(counts), sum(counts) + counts.count(0), counts.count(0)), doc_id
    assert got[18][2] > 0 and token_counts.token_counts(no_docs).count() == 0


def test_automaton_on_random_vocabularies():
    rng = random.Random(2)
    for _ in range(500):
        vocabulary = {"".join(rng.choices("▁abc", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        automaton = token_counts.Automaton(vocabulary)
        for _ in range(8):
            word = "▁" + "".join(rng.choices("abcd", [5, 5, 5, 1], k=rng.randint(0, 9)))
            n = at = 0
            while at < len(word):
                step = next((k for k in range(5, 0, -1) if word[at : at + k] in vocabulary and at + k <= len(word)), 0)
                if not step:
                    n = 0
                    break
                at, n = at + step, n + 1
            assert automaton.count(word) == n


def test_sentencepiece_round_trip(docs, no_docs):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = pieces.decoded(pieces.encoded(docs)).collect()
    for r in rows:
        assert r.ids == model.encode(r.text or "") and r.decoded == (r.text or "")
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert pieces.encoded(no_docs).count() == 0


def test_sentencepiece_on_odd_texts():
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    mine = pieces.Pieces(*pieces.read_model())
    rng = random.Random(3)
    letters = [*"abcdehinorst  ▁\n\t'é漢ß.,!?0199ING", "  ", "    ", "the", "tion", "\x00"]
    batch = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(2000)]
    for text, coded in zip(batch, mine.encode_batch(batch)):
        ids = np.frombuffer(coded, "<u4").tolist()
        assert ids == model.encode(text) and mine.decode(ids) == text.replace("▁", " ")


def test_unigram_viterbi_against_every_segmentation():
    rng = random.Random(4)
    for _ in range(60):
        made = {"".join(rng.choices("ab", k=rng.randint(1, 4))) for _ in range(6)} | {"▁", "a", "b", "▁a"}
        entries = [(p, -rng.random() * 10) for p in sorted(made)]
        vocabulary = pieces.Pieces(list(entries), [], merges=False)
        scores = dict(entries)

        def best(word):
            if not word:
                return 0.0
            ends = [k for k in range(1, len(word) + 1) if word[:k] in scores or k == 1]
            return max(scores.get(word[:k], vocabulary.unknown) + best(word[k:]) for k in ends)

        texts_ = ["".join(rng.choices("ab ", k=rng.randint(1, 8))) for _ in range(10)]
        for text, coded in zip(texts_, vocabulary.encode_batch(texts_)):
            ids = np.frombuffer(coded, "<u4").tolist()
            total = sum(entries[i][1] for i in ids)
            assert total == pytest.approx(sum(best(c) for c in vocabulary._chunk.findall("▁" + text.replace(" ", "▁"))))


def made(rng, syllables, words):
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(words))


ENGLISH, GERMAN = "the of ing er an th on".split(), "der sch und ich ung ein ß".split()


def test_language_identification(spark, docs, no_docs):
    rng = random.Random(6)
    rows = [(k, made(rng, ENGLISH if k % 2 else GERMAN, 40), "en" if k % 2 else "de") for k in range(80)]
    rows += [(90 + k, "привет мир как дела это текст " * 3, "ru") for k in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df)
    mixed = made(rng, ENGLISH, 30) + ". " + made(rng, GERMAN, 15) + ". " + made(rng, ENGLISH, 5)
    asked = [(1, made(rng, GERMAN, 9)), (2, mixed), (3, "мир текст"), (4, "12 -- ²"), (5, None), (6, "漢字")]
    got = by_id(langid.identified(spark.createDataFrame(asked, "doc_id long, text string"), model), "lang_pred", "score", "spans")
    assert got[1][0] == "de" and got[3][0] == "ru" and got[4] == got[5] == ("und", 0.0, [])
    spans = [(s.lang, s.first, s.words) for s in got[2][2]]
    assert [s[0] for s in spans[:2]] == ["en", "de"] and abs(spans[0][2] - 30) <= 1 and got[2][0] == "en"
    assert got[6][0] in ("de", "en", "ru")
    assert langid.keep_identified(docs, model).columns == docs.columns
    assert langid.identified(no_docs, model).count() == 0
    assert by_id(langid.identified(docs, langid.train(no_docs)), "lang_pred")[7] == ("und",)


def test_language_model_counts_a_text_once(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(made(rng, ENGLISH, 40), "en") for _ in range(30)] + [(made(rng, GERMAN, 40), "de") for _ in range(30)]
    df = spark.createDataFrame(rows, "text string, lang string")
    hot = df.union(spark.range(3000).selectExpr(f"'{made(rng, ENGLISH, 40)}'", "'en'"))
    for bound in (100, 20):  # more than the texts of a language, and fewer
        monkeypatch.setattr(langid, "TRAIN_DOCS", bound)
        model, copied = langid.train(hot.distinct()), langid.train(hot)
        assert copied.languages == model.languages == ["de", "en"]
        assert all((a == b).all() for a, b in zip(copied.parts()[1:], model.parts()[1:]))


def test_unlearned_scripts_have_no_vote(spark):
    rng = random.Random(10)
    df = spark.createDataFrame([(made(rng, s, 40), l) for s, l in ((ENGLISH, "en"), (GERMAN, "de")) for _ in range(30)], "text string, lang string")
    model = langid.train(df)
    english = made(rng, ENGLISH, 20)
    letters = sum(map(str.isalpha, english))
    asked = [(1, "漢字 仮名 " * 9), (2, english + " " + "漢" * (2 * letters)), (3, english + " " + "漢" * (letters // 2))]
    asked += [(4, english + " " + made(rng, GERMAN, 20)), (5, english), (6, None)]
    docs = spark.createDataFrame(asked, "doc_id long, text string")
    got = by_id(langid.identified(docs, model), "lang_pred", "score")
    assert got[1][0] in ("de", "en") and got[1][1] == 0.0 and got[5] == ("en", 1.0)
    assert got[2][0] == got[3][0] == "en" and got[2][1] == pytest.approx(1 / 3) and got[3][1] == pytest.approx(2 / 3, abs=0.01)
    assert {r.doc_id for r in langid.keep_identified(docs, model).collect()} == {3, 4, 5}


def test_viterbi_against_every_labelling():
    import itertools

    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = rng.integers(0, 6, 4)
        words = rng.integers(0, 7, sizes.sum())
        scores = (rng.normal(0, 6, (7, 3))).astype(np.float32)
        labels = langid.viterbi(scores, words, sizes)
        for begin, size in zip(np.cumsum(sizes) - sizes, sizes):
            def total(path):
                return sum(scores[w, p] for w, p in zip(words[begin : begin + size], path)) - langid.SWITCH * sum(
                    a != b for a, b in zip(path, path[1:])
                )

            best = max(map(total, itertools.product(range(3), repeat=int(size))))
            assert total(labels[begin : begin + size]) == pytest.approx(best, abs=1e-3)


def test_toxicity(spark, docs, no_docs, prose):
    rng = random.Random(8)

    def text(insult, group):
        words = prose(rng.randint(0, 10**6), 60).split()
        for word in (["grobian"] if insult else []) + (["lowlander"] if group else []):
            words.insert(rng.randrange(len(words)), word)
        return " ".join(words)

    kinds = [(k % 2, k // 2 % 2) for k in range(1600)]
    df = spark.createDataFrame([(k, text(*x)) for k, x in enumerate(kinds)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, a & b) for k, (a, b) in enumerate(kinds) if k % 4 or k % 3], "doc_id long, toxic int")
    machine = toxicity.train(df, labels)
    got = by_id(toxicity.scored(df, machine), "score", "predicted")
    right = sum(got[k][1] == (a & b) for k, (a, b) in enumerate(kinds))
    assert right / len(kinds) > 0.97
    awkward = by_id(toxicity.scored(docs, machine), "score", "predicted")
    assert awkward[1] == awkward[2] and all(0 <= s <= 1 for s, _ in awkward.values())
    nothing = toxicity.train(no_docs, labels.limit(0))
    assert toxicity.scored(docs, nothing).count() == docs.count() and toxicity.scored(no_docs, machine).count() == 0


def test_pair_terms_are_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    machine = toxicity.Machine(np.arange(9), 0.3, rng.normal(size=9), rng.normal(size=(9, 4)))
    terms = np.array([1, 4, 7, 8])
    pairs = sum(machine.factors[a] @ machine.factors[b] for i, a in enumerate(terms) for b in terms[i + 1 :])
    want = 0.3 + machine.weights[terms].sum() + pairs
    assert machine.margins(np.zeros(4, int), terms, 1)[0] == pytest.approx(want)


def test_toxicity_of_both_or_neither(spark, prose):
    """Neither word says anything alone: only the pair does."""
    rng = random.Random(18)
    kinds = [(rng.random() < 0.5, rng.random() < 0.5) for _ in range(4800)]
    rows = []
    for k, (insult, group) in enumerate(kinds):
        words = prose(rng.randint(0, 10**6), 14).split() + ["grobian"] * insult + ["lowlander"] * group
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(a == b)) for k, (a, b) in enumerate(kinds) if k % 3], "doc_id long, toxic int")
    got = by_id(toxicity.scored(df, toxicity.train(df, labels)), "score")
    held = [(got[k][0] >= 0.5) == (a == b) for k, (a, b) in enumerate(kinds) if not k % 3]
    assert sum(held) / len(held) > 0.9


def test_toxicity_of_rows_without_terms(spark):
    """Batches without a kept term: no text at all, and words that no other row has."""
    df = spark.createDataFrame([(k, f"{'ab'[k % 2] * (k + 1)}" if k % 3 else "") for k in range(900)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(900)], "doc_id long, toxic int")
    machine = toxicity.train(df, labels)
    assert all(0 <= r.score <= 1 for r in toxicity.scored(df, machine).collect())
    empty = toxicity.train(df.withColumn("text", F.lit("1 2 3")), labels)
    assert len(empty.kept) == 0 and {round(r.score, 1) for r in toxicity.scored(df, empty).collect()} == {0.5}


def test_substring_removal_of_repeated_ids(spark, prose):
    """An id whose rows differ: every row is cut by its own words and none is multiplied."""
    one, two, three = prose(60, 25), prose(61, 30), prose(62, 40)
    rows = [(1, one), (2, two), (5, one), (5, two), (5, three), (5, three), (5, None), (5, "short"), (6, three), (7, f"{three} end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.removed(df).collect()))
    assert got == sorted([
        (1, 25, 0, one), (2, 30, 0, two), (5, 25, 25, ""), (5, 30, 30, ""), (5, 40, 0, three), (5, 40, 0, three),
        (5, 0, 0, ""), (5, 1, 0, "short"), (6, 40, 40, ""), (7, 41, 40, "end"),
    ])


@pytest.mark.parametrize("bound", [0, 1 << 30])
def test_joins_by_shuffle_and_by_broadcast(docs, monkeypatch, bound):
    monkeypatch.setattr(common, "BROADCAST_BYTES", bound)
    test_substring_removal(docs, docs.limit(0))
    rows = {r.doc_id: r.component_id for r in ngram_join.linked_components(docs).collect()}
    assert rows[8] == 7 and rows[10] == 9 and rows[5] == 4


def test_every_label_is_learned(spark):
    """Over 512 labels, and more than the scores' table is laid out for."""
    rng = random.Random(21)
    own = {f"l{k:03d}": "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for k in range(600)}
    df = spark.createDataFrame([(f"{w} " * 30, lang) for lang, w in own.items()], "text string, lang string")
    model = langid.train(df)
    assert model.languages == sorted(own)
    asked = spark.createDataFrame([(k, f"{w} {w}") for k, w in enumerate(own.values())], "doc_id long, text string")
    got = by_id(langid.identified(asked, model), "lang_pred")
    assert [got[k][0] for k in range(600)] == list(own)


def test_scores_are_the_same_laid_out_or_not(spark, monkeypatch):
    rng = random.Random(22)
    df = spark.createDataFrame([(made(rng, s, 40), l) for s, l in ((ENGLISH, "en"), (GERMAN, "de")) for _ in range(20)], "text string, lang string")
    model = langid.train(df)
    words = [*set(made(rng, ENGLISH + GERMAN, 300).split()), "x" * 50_000]
    table, _ = model.of_words(words)
    monkeypatch.setattr(langid, "TABLE", 0)
    monkeypatch.setattr(langid, "CELLS", 1000)
    sparse, _ = langid.Model(*model.parts()).of_words(words)
    np.testing.assert_allclose(table, sparse, rtol=2e-4)


def test_marks_stay_with_their_letters(spark):
    assert langid.word_lists(pa.array(["मैं आज बाजार e\u0301te"])) == [["मैं", "आज", "बाजार", "e\u0301te"]]
    hindi, marathi = "मैं आज बाजार जा रहा हूँ और वह नहीं है", "मी आज बाजारात जात आहे आणि तो नाही आहे"
    model = langid.train(spark.createDataFrame([(hindi, "hi"), (marathi, "mr")], "text string, lang string"))
    asked = spark.createDataFrame([(1, "मैं नहीं जा रहा हूँ"), (2, "मी जात नाही आहे")], "doc_id long, text string")
    assert by_id(langid.identified(asked, model), "lang_pred") == {1: ("hi",), 2: ("mr",)}
