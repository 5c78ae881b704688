import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tierline.llm import exact_dedup


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub("[\x20\t-\r]+", " ", text or ""), []).append(doc_id)
    return {d: (min(ids), len(ids), d == min(ids), hashlib.sha256(t.encode()).hexdigest())
            for t, ids in groups.items() for d in ids}


def test_against_brute_force(documents, by_id):
    rng = random.Random(1)
    texts = [None, "", " ", "a  b", "a\tb", "a b ", "a b", "x" * 200_000, "x" * 200_000, "é\n\né"]
    texts += [rng.choice("ab") * rng.randint(1, 6) for _ in range(300)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    found = by_id(exact_dedup.mark(documents(*rows).repartition(7)).drop("digest"))
    assert {d: tuple(r)[1:] for d, r in found.items()} == expected(rows)


def test_rows_that_repeat_an_id_and_missing_ids(documents):
    docs = documents((3, "a"), (3, "a"), (None, "a"), (None, "b"), (None, "b"), (5, "b c"), (3, "b c"))
    kept = exact_dedup.mark(docs).filter("kept").select("doc_id", "group_size").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(3, 3), (None, 2), (3, 2)], key=str)
    stay = exact_dedup.deduplicate(docs)
    assert sorted((r.doc_id, r.text) for r in stay.collect() if r.doc_id) == [(3, "a"), (3, "b c")]
    assert stay.filter("doc_id IS NULL").count() == 1 and stay.columns == docs.columns


def test_other_columns_may_have_any_name(documents):
    docs = documents("a", "a", "b").withColumns({c: F.lit(1) for c in ("digest", "kept", "slot", "row", "tag", "least")})
    stay = exact_dedup.deduplicate(docs)
    assert stay.columns == docs.columns and sorted(r.doc_id for r in stay.collect()) == [0, 2]


def test_empty_table(documents):
    assert exact_dedup.mark(documents()).count() == 0 and exact_dedup.deduplicate(documents()).count() == 0


def test_a_hot_text_is_folded_before_it_moves(documents, spark):
    docs = documents(*(["same"] * 3000 + [f"t{i}" for i in range(500)])).repartition(8)
    runs = exact_dedup.merge_runs(exact_dedup.keyed(docs))
    sizes = sorted(r["size"] for r in runs.collect())
    assert sizes[-1] == 3000 and len(sizes) == 501
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan and "Python" not in plan


@pytest.mark.parametrize("partitions,rounds", [(1, 1), (8, 1), (9, 2), (64, 2), (211, 3), (5000, 5)])
def test_rounds(partitions, rounds):
    assert exact_dedup._rounds(partitions) == rounds
