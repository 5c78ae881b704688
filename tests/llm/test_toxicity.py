import random
import zlib

import pytest
from pyspark.sql import functions as F

from tierline.llm import toxicity as tox

PLAIN = "the of and in to that it on river stone walk green old paper light house under table window".split()


def corpus(n=1500, seed=11):
    """Texts and labels; toxic ones hold known insults, made-up ones by stem, or both."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = rng.choices(PLAIN, k=rng.randint(5, 60))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["grubel", "idiot", "moron"]) + rng.choice(["", "en", "ov"]))
        rows.append((i, " ".join(words) + ".", int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark, documents):
    rows = corpus()
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return tox.fit(documents(*((i, t) for i, t, _ in rows)), labels)


def test_held_out_accuracy(documents, model, by_id):
    rows = corpus(600, seed=12)
    found = by_id(tox.score(documents(*((i, t) for i, t, _ in rows)), model))
    for i, _, toxic in rows:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert found[i].predicted == (found[i].score >= 0.5) and 0 <= found[i].score <= 1
    assert sum(found[i].predicted == y for i, _, y in rows) >= 0.99 * len(rows)


def test_word_beginnings_are_learned(documents, model, by_id):
    found = by_id(tox.score(documents("the river grubelzat and grubelix of stone", "the river and stone"), model))
    assert found[0].predicted == 1 and found[1].predicted == 0


def test_held_out_labels_and_other_columns_are_never_used(spark, documents):
    rows = corpus(400)
    docs = documents(*((i, t) for i, t, _ in rows))
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    turned = labels.withColumn("toxic", F.when(tox.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tox.fit(docs, labels), tox.fit(docs.withColumns({"lang": F.lit("x"), "toxic": F.lit(1), "row": F.lit(0)}), turned)
    assert (a.words, a.prefixes, a.weights.tolist()) == (b.words, b.prefixes, b.weights.tolist())


def test_the_sample_is_bounded(spark, documents):
    rows = corpus(400)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    kept = tox._training_rows(documents(*((i, t) for i, t, _ in rows)).select("doc_id", "text"), labels, 50)
    assert kept.count() <= 50


def run(machine, *symbols):
    state, out = machine.start, []
    for s in symbols:
        state, o = machine.step(state, s)
        out.append(o)
    return out


def test_grammar():
    n, i, t, r, q, o = tox.NEGATOR, tox.STRONG, tox.TARGET, tox.REPORT, tox.QUOTE, tox.OTHER
    assert run(tox.GRAMMAR, n, o, i)[-1] == tox.NEGATED
    assert run(tox.GRAMMAR, n, o, o, o, i)[-1] == tox.STRONG
    assert run(tox.GRAMMAR, r, q, i)[-1] == tox.REPORTED
    assert run(tox.GRAMMAR, t, o, i)[-1] == tox.AIMED
    assert run(tox.GRAMMAR, i, o, t)[-1] == tox.AIMED
    assert run(tox.GRAMMAR, t, tox.THREAT)[-1] == tox.AIMED_THREAT
    assert run(tox.GRAMMAR, o, i)[-1] == tox.STRONG


def test_composed_table_is_the_machine():
    rng, table = random.Random(13), tox.GRAMMAR.table()
    for _ in range(50):
        symbols = [rng.randrange(9) for _ in range(20)]
        state, out = 0, []
        for s in symbols:
            state, o = table[state][s]
            out.append(o)
        assert out == run(tox.GRAMMAR, *symbols)


def test_clauses_not_words(model):
    symbols, table = tox.Symbols(model), tox.GRAMMAR.table()
    joined = tox.features("you idiot and you moron", symbols, table)
    apart = tox.features("you idiot. you moron", symbols, table)
    assert apart[-2] > joined[-2] and apart[-1] < joined[-1]


def test_without_usable_labels(spark, documents, by_id):
    docs = documents(None, "", "you are an idiot, you moron, you scum", "x" * 300_000, "word " * 50_000)
    for labels in ([], [(2, 1)], [(None, 1), (2, None)], [(99, 1)]):
        frame = spark.createDataFrame(labels, "doc_id long, toxic int")
        found = by_id(tox.score(docs, tox.fit(docs, frame)))
        assert [found[i].predicted for i in range(5)] == [0, 0, 1, 0, 0]


def test_rows_and_columns(documents, model):
    docs = documents((1, "you idiot moron idiot"), (1, "a river"), (1, "a river"), (None, "a river"), (2, None)).withColumns(
        {c: F.lit(0) for c in ("score", "predicted", "held_out", "toxic")})
    assert sorted((str(r.doc_id), r.held_out and r.doc_id is None, r.predicted) for r in tox.score(docs, model).collect()) == [
        ("1", False, 0), ("1", False, 0), ("1", False, 1), ("2", False, 0), ("None", False, 0)]
    clean = tox.keep_clean(docs, model)
    assert clean.columns == docs.columns and clean.count() == 4
    assert tox.score(documents(), model).count() == 0 and tox.keep_clean(documents(), model).count() == 0
