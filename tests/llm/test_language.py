import itertools
import random
import zlib

import numpy as np
import pytest

from tierline.llm import language, queries
from tierline.llm.scripts import NAMES, code_points, words

SF_DIR = "/root/testdata/sf0.01"
WORDS = {"en": "the house under stone river with green paper walking light through that".split(),
         "de": "der Straße über grün schön nicht zwischen Häuser gehen durch Licht Fluss".split(),
         "ru": "дом река зелёный бумага под свет через этот камень большой".split(),
         "el": "σπίτι ποτάμι πράσινο χαρτί κάτω φως μέσα πέτρα".split()}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def learned(i):
    return zlib.crc32(str(i).encode()) % 3 != 1


def corpus(seed=1, n=200):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(WORDS[lang], k=rng.randint(3, 60))), lang, "s", 0)
            for i in range(n) for lang in [rng.choice(list(WORDS))]]


def test_held_out_documents_of_clear_languages(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    found = {r.doc_id: r for r in language.identify(docs, language.fit(docs)).collect()}
    for i, _, lang, *_ in rows:
        assert found[i].held_out != learned(i)
        assert found[i].lang_pred == lang and 0.9 < found[i].score <= 1


def test_labels_of_held_out_documents_and_other_columns_change_nothing(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    wrong = spark.createDataFrame([(i, t, lang if learned(i) else "xx", "other", 9) for i, t, lang, *_ in rows], DOCS)
    wrong = wrong.selectExpr("*", "'q' AS chunk", "1 AS counts", "true AS held_out", "'z' AS lang_pred")
    a, b = language.fit(docs), language.fit(wrong)
    assert a.languages == b.languages and np.array_equal(a.places, b.places) and np.array_equal(a.candidates, b.candidates)
    assert sorted(language.identify(docs, a).collect()) == sorted(language.identify(wrong, b).collect())


def test_spans_of_a_mixed_text(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    parts = [("de", " ".join(WORDS["de"])), ("en", " ".join(WORDS["en"])), ("ru", " ".join(WORDS["ru"])), ("en", " ".join(WORDS["en"]))]
    text = ", ".join(p for _, p in parts)
    row = language.identify(spark.createDataFrame([(1, text, None, "s", 0)], DOCS), language.fit(docs)).first()
    assert [s.lang for s in row.spans] == [lang for lang, _ in parts]
    assert [text[s.start:s.end] for s in row.spans] == [p for _, p in parts]
    letters = {}
    for lang, p in parts:
        letters[lang] = letters.get(lang, 0) + sum(c.isalpha() for c in p)
    assert row.lang_pred == max(letters, key=letters.get) == "en"
    assert row.score == pytest.approx(letters["en"] / sum(letters.values()))


def test_texts_without_letters_nulls_and_repeats(spark):
    rows = corpus() + [(500, None, "en", "s", 0), (501, "", "en", "s", 0), (502, "12 %$ 3.4\n", "en", "s", 0), (None, "the house", None, "s", 0),
                       (7, "the house under", None, "s", 0), (7, "the house under", None, "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    out = language.identify(docs, language.fit(docs)).collect()
    assert len(out) == len(rows)
    assert all((r.lang_pred, r.score, r.spans) == ("und", 0.0, []) for r in out if r.doc_id in (500, 501, 502))
    assert [(r.lang_pred, r.held_out) for r in out if r.doc_id is None] == [("en", False)]
    assert sum(r.doc_id == 7 for r in out) == 3


def test_without_training_texts_and_without_rows(spark):
    docs = spark.createDataFrame([(1, "the house", None, "s", 0), (2, None, "en", "s", 0)], DOCS)
    assert {r.lang_pred for r in language.identify(docs, language.fit(docs)).collect()} == {"und"}
    empty = spark.createDataFrame([], DOCS)
    assert language.identify(empty, language.fit(empty)).collect() == []


def test_long_texts_are_labelled_whole(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame(corpus(), DOCS)
    half = " ".join(rng.choices(WORDS["de"], k=90_000))
    text = half + " " + " ".join(rng.choices(WORDS["en"], k=100_000)) + " " + "x" * (language.PIECE + 10)
    row = language.identify(spark.createDataFrame([(1, text, None, "s", 0)], DOCS), language.fit(docs)).first()
    assert row.spans[0].lang == "de" and row.spans[0].end == len(half) and row.spans[-1].end == len(text)


def plain_viterbi(scores, switch):
    n, k = scores.shape
    best = max(itertools.product(range(k), repeat=n),
               key=lambda p: sum(scores[i, l] for i, l in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:])))
    return list(best)


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(4)
    counts = np.array([5, 0, 1, 6, 3])
    scores = rng.normal(size=(counts.sum(), 3)) * 2
    firsts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    got = language.viterbi(scores, firsts, counts, 1.5)
    for first, count in zip(firsts, counts):
        if count:
            assert got[first:first + count].tolist() == plain_viterbi(scores[first:first + count], 1.5)


def test_sequences_against_plain_strings():
    def bucket(letters):
        rolling = ord(letters[0]) * 0x9E3779B1 % (1 << 32)
        for c in letters[1:]:
            rolling = ((rolling ^ (rolling >> 15)) * 0x85EBCA77 + ord(c)) % (1 << 32)
        mixed = rolling * 0xC2B2AE3D % (1 << 32)
        return (mixed ^ (mixed >> 13)) >> 16

    text = "Ab, ÇĞe x дом"
    points = code_points(text)
    starts, ends, kinds = words(points)
    assert [text[a:b] for a, b in zip(starts, ends)] == ["Ab", "ÇĞe", "x", "дом"]
    assert [NAMES[k] for k in kinds] == ["latin", "latin", "latin", "cyrillic"]
    found, firsts = language.sequences(points, starts, ends)
    stops = [*firsts[1:], len(found[0])]
    for word, a, b in zip(["ab", "çğe", "x", "дом"], firsts, stops):
        marked = f" {word} "
        for size, places in zip(language.SIZES, found):
            expected = [bucket(marked[i:i + size]) for i in range(len(marked) - size + 1)]
            assert [p for p in places[a:b].tolist() if p < language.BUCKETS] == expected


def test_texts_labelled_together_or_apart(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choices(WORDS[rng.choice(list(WORDS))], k=rng.randint(0, 40))) for _ in range(50)] + ["", "1 2"]
    scripts = np.ones((len(NAMES), 2), bool)
    model = language.Model(("a", "b"), np.random.default_rng(1).normal(size=(language.BUCKETS + 1, 2)).astype(np.float32), scripts)
    want = [[x.tolist() for x in t] for t in language._label(model, texts)]
    monkeypatch.setattr(language, "TOGETHER", 10)
    monkeypatch.setattr(language, "PIECE", 60)
    assert [[x.tolist() for x in t] for t in language._label(model, texts)] == want and len(want) == len(texts)


def test_query_on_held_out_rows(spark):
    found = {r.doc_id: r for r in queries.op12_language(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(found) == len(docs)
    held = [d for d in docs if not learned(d.doc_id)]
    assert all(found[d.doc_id].held_out for d in held)
    right = sum(found[d.doc_id].lang_pred == d.lang for d in held)
    assert right / len(held) > 0.9
    print(right / len(held), len(held), [(found[d.doc_id].lang_pred, found[d.doc_id].score, d.lang, d.text[:80]) for d in held if found[d.doc_id].lang_pred != d.lang][:10])
