import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import substrings


def expected(rows):
    """{id: (bytes, removed, spans, kept)} by looking at every window in order."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            if data[i:i + 100] in seen:
                gone[i:i + 100] = True
            seen.add(data[i:i + 100])
        spans = sum(1 for k, _ in itertools.groupby(gone) if k)
        out[doc_id] = (len(data), int(gone.sum()), spans, bytes(np.frombuffer(data, np.uint8)[~gone]))
    return out


def found(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()}


def texts(seed, n):
    rng = random.Random(seed)

    def noise(k):
        return "".join(rng.choices("abcdefghij é", k=k))
    passages = [noise(k) for k in (98, 99, 100, 101, 130, 156, 157, 400)]
    out = [None, "", "a" * 99, "a" * 100, "a" * 300, "ab" * 300, "é" * 120, "x" + "a" * 150, noise(30_000)]
    for _ in range(n):
        text = noise(rng.randint(0, 150))
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            text += p[rng.randint(0, 20):len(p) - rng.randint(0, 20)] + noise(rng.randint(0, 60))
        out.append(text)
    return out + out[5:20]


def test_cover_has_every_difference():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


@pytest.mark.parametrize("seed", [14, 15])
def test_against_brute_force(documents, seed):
    rows = list(enumerate(texts(seed, 60)))
    random.Random(seed).shuffle(rows)
    assert found(substrings.remove_repeats(documents(*rows).repartition(6))) == expected(rows)


def test_small_units_and_many_buckets(documents, monkeypatch):
    monkeypatch.setattr(substrings, "NAMES", 50)
    rows = list(enumerate(texts(16, 30)))
    assert found(substrings.remove_repeats(documents(*rows).repartition(30))) == expected(rows)


def test_ids_that_repeat_or_are_missing(documents):
    passage = "".join(random.Random(17).choices("abcdefghij", k=200))
    docs = documents((5, passage), (5, passage), (None, passage), (7, "z" + passage)).withColumns(
        {c: F.lit(0) for c in ("unit", "data", "bucket", "found", "lengths", "kept")})
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in substrings.remove_repeats(docs, digests=True).collect()))
    assert rows == [(False, 5, 0), (False, 5, 200), (False, 7, 200), (True, 0, 200)]


def test_empty_table(documents, spark):
    assert substrings.remove_repeats(documents()).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("units_")]


@pytest.mark.parametrize("block", [50, 1 << 14])
def test_window_names_agree_exactly_on_equal_windows(monkeypatch, block):
    monkeypatch.setattr(substrings, "_BLOCK", block)
    rng = np.random.default_rng(18)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    whole, half = substrings.doubled_names(data, 64, 32)
    for length, size, names in ((64, 64, whole), (32, 32, half), (44, 32, half), (100, 64, whole)):
        if length != size:
            names = substrings.window_names(names, size, np.arange(len(data) - length + 1), length)
        by_window = {}
        for i, name in enumerate(names.tolist()):
            assert by_window.setdefault(bytes(data[i:i + length]), name) == name
        assert len(set(by_window.values())) == len(by_window) and len(names) == 3001 - length
    assert all(len(n) == 0 for n in substrings.doubled_names(data[:20], 32, 64))


def test_numbers_survive_their_planes():
    values = np.array([0, 1, 2 ** 63, 2 ** 64 - 1, 300], np.uint64)
    assert substrings._from_planes(substrings._planes(values)).tolist() == values.tolist()


def test_texts_are_not_shuffled_after_the_first_write(documents, spark, monkeypatch):
    plans = []
    monkeypatch.setattr(substrings, "stored", lambda df, purpose, f=substrings.stored: (plans.append(df), f(df, purpose))[1])
    substrings.remove_repeats(documents(*texts(19, 20)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in plans:
            text = df._jdf.queryExecution().toString()
            assert "Exchange" not in "".join(line for line in text.splitlines() if "data#" in line and "hashpartitioning" in line)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
